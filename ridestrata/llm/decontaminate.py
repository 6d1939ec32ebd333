"""Benchmark decontamination by greedy string tiling.

Texts and test items are sequences of lower-cased words. Runs of ``match`` words that
a text shares with an item are seeds; texts are scanned once against a bitmap of the
seeds, and only those that hit it go on to an equi-join of seeds. Each text and item
that meet there are tiled: matching stretches of both are marked, longest first and
without overlap, found by a running Karp-Rabin hash whose length falls step by step to
``match``. An item of which the tiles cover enough words leaks, wherever the parts of it
stand in the text."""

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestrata.llm.repeats import deepen
from ridestrata.operators.stored import lookup_join, store

MATCH = 5
COVERAGE = 0.6
BITS_PER_SEED = 256
LEAST_BITS, MOST_BITS = 25, 28  #: the bitmap of seeds has two to these many bits, 4 to 32 MB
WORDS = re.compile(r"\w+")
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def tokens(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


class _Names(dict):
    """64-bit names of words, kept up to a limit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_names = _Names()


def _runs(texts: list[list[str]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of ``size`` words, and the text of each."""
    flat = np.fromiter((_names[word] for words in texts for word in words), dtype=np.uint64)
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))
    whole = left >= size
    return deepen(flat, 1, size)[whole], text[whole]


def _seeds(items: DataFrame, match: int) -> DataFrame:
    """(seed, item_id, n, places): the runs of each item and at how many places of it
    each stands; an item with fewer words than ``match`` is one run of its own length.
    ``n`` is the length of the item."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                words = tokens(text)
                if not words:
                    continue
                found, places = np.unique(_runs([words], min(match, len(words)))[0], return_counts=True)
                ids, lengths = [item_id] * len(found), [len(words)] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(ids, pa.int64()), pa.array(lengths, pa.int32()), pa.array(places, pa.int32())],
                    ["seed", "item_id", "n", "places"],
                )

    return items.mapInArrow(batches, "seed long, item_id long, n int, places int")


def _probes(names: np.ndarray, width: int) -> list[np.ndarray]:
    """The places of names in a bitmap of 2**width bits: their first and their last bits."""
    return [names >> np.uint64(64 - width), names & np.uint64((1 << width) - 1)]


def _known(names: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Which names have all their bits in the bitmap."""
    known = np.ones(len(names), dtype=bool)
    for place in _probes(names, width):
        known &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return known


def _bitmap(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap with two bits for each seed, and its width. With ``BITS_PER_SEED`` places or
    more for a seed, at most one run in 16,000 is known by chance; beyond a million seeds
    the bitmap grows no more and more runs are, which the join of seeds drops.
    2**(MOST_BITS - 6) rows at most reach the driver, as Arrow."""
    wanted = max(seeds.select("seed").distinct().count(), 1) * BITS_PER_SEED
    width = min(max((wanted - 1).bit_length(), LEAST_BITS), MOST_BITS)
    both = F.array(F.shiftrightunsigned("seed", 64 - width), F.col("seed").bitwiseAND(F.lit((1 << width) - 1)))
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    words = seeds.select(F.explode(both).alias("bit")).groupBy(F.shiftrightunsigned("bit", 6).alias("place"))
    rows = words.agg(F.bit_or(one).alias("bits")).toArrow()
    bits = np.zeros(1 << (width - 6), dtype=np.uint64)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits, width


def _suspects(docs: DataFrame, seeds: DataFrame, match: int) -> DataFrame:
    """(doc_id, text, seeds) of the texts with a run that the bitmap knows."""
    bits, width = _bitmap(seeds)
    lengths = sorted({match} | {row["n"] for row in seeds.where(F.col("n") < match).select("n").distinct().collect()})

    def hits(texts: list[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        found, owner = [], []
        for size in lengths:
            names, text = _runs(texts, size)
            known = _known(names, bits, width)
            found.append(names[known])
            owner.append(text[known])
        names, text = np.concatenate(found), np.concatenate(owner)
        for number in np.unique(text):
            yield int(number), np.unique(names[text == number])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = list(hits([tokens(text) for text in part["text"].to_pylist()]))
                if found:
                    chosen = pa.array([number for number, _ in found], pa.int64())
                    lists = pa.array([names.view(np.int64) for _, names in found], pa.list_(pa.int64()))
                    columns = [part["doc_id"].take(chosen), part["text"].take(chosen), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "seeds"])

    return docs.mapInArrow(batches, "doc_id long, text string, seeds array<long>")


def _rolling(values: list[int], size: int, free: list[bool]) -> Iterator[tuple[int, int]]:
    """(place, hash) of each stretch of ``size`` values that is free throughout."""
    top = pow(_BASE, size - 1, _MODULUS)
    rolled, run = 0, 0
    for place, value in enumerate(values):
        if not free[place]:
            rolled = run = 0
            continue
        if run >= size:
            rolled -= values[place - size] * top
        rolled = (rolled * _BASE + value) % _MODULUS
        run += 1
        if run >= size:
            yield place - size + 1, rolled


def _common(item: np.ndarray, p: int, text: np.ndarray, t: int) -> int:
    """How many values from these places on are equal."""
    done, step = 0, 16
    while True:
        a, b = item[p + done : p + done + step], text[t + done : t + done + step]
        size = min(len(a), len(b))
        differ = np.flatnonzero(a[:size] != b[:size])
        if len(differ):
            return done + int(differ[0])
        done += size
        if size < step:
            return done
        step *= 2


def _matches(item: list[int], text: list[int], free_item: list[bool], free_text: list[bool], size: int):
    """(-length, place in item, place in text) of the free stretches of at least ``size``
    values that both have and no value before extends. Places of the item are kept by
    their hash and by the value before them, so a text that repeats itself meets only
    those at which a match begins."""
    begins: dict[int, dict[int, list[int]]] = {}
    for p, rolled in _rolling(item, size, free_item):
        before = item[p - 1] if p and free_item[p - 1] else 0
        begins.setdefault(rolled, {}).setdefault(before, []).append(p)
    a = np.where(free_item, item, -1)
    b = np.where(free_text, text, -2)
    found = []
    for t, rolled in _rolling(text, size, free_text):
        groups = begins.get(rolled)
        if groups:
            before = text[t - 1] if t and free_text[t - 1] else -1
            for value, places in groups.items():
                if value != before:
                    for p in places:
                        k = _common(a, p, b, t)
                        if k >= size:
                            found.append((-k, p, t))
    return found


def tiles(item: list[int], text: list[int], match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of positive numbers: (place in item,
    place in text, length), longest first, each place in one tile at most. Of equally long
    matches the first by place in the item, then in the text, is marked."""
    free_item, free_text = [True] * len(item), [value > 0 for value in text]
    found: list[tuple[int, int, int]] = []
    size = max(match, min(len(item), 20))
    while any(free_item):
        queue = _matches(item, text, free_item, free_text, size)
        longest = -min((k for k, _, _ in queue), default=0)
        if longest > 2 * size:
            size = longest
            continue
        heapq.heapify(queue)
        marked = False
        while queue:
            k, p, t = heapq.heappop(queue)
            k = -k
            # What a tile has taken of a match parts it; what is left behind the last such
            # place waits for its turn, shorter pieces before it are found in the next round.
            taken = max((i for i in range(k) if not (free_item[p + i] and free_text[t + i])), default=-1) + 1
            if taken:
                if k - taken >= size:
                    heapq.heappush(queue, (taken - k, p + taken, t + taken))
                continue
            free_item[p : p + k] = [False] * k
            free_text[t : t + k] = [False] * k
            found.append((p, t, k))
            marked = True
        if marked:
            continue
        if size == match:
            return found
        size = max(match, size // 2)
    return found


def covered(item: list[str], text: list[str], match: int) -> tuple[int, int]:
    """How many words of the item are in tiles, and how many tiles."""
    numbers = {word: number for number, word in enumerate(dict.fromkeys(item), 1)}
    # Words that the item lacks part the text; they cannot be in a tile.
    found = tiles([numbers[word] for word in item], [numbers.get(word, 0) for word in text], min(match, len(item)))
    return sum(k for _, _, k in found), len(found)


LEAK = "doc_id long, key long, item_id long, n_tokens int, n_covered int, coverage double, n_tiles int"


def leaks(docs: DataFrame, items: DataFrame, match: int = MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, key, item_id, n_tokens, n_covered, coverage, n_tiles): one row for each
    text of ``docs`` (doc_id, text) and item of ``items`` (item_id, text) of which tiles
    of at least ``match`` words cover ``coverage`` or more. ``key`` is a hash of the text.

    Items with fewer words than ``match`` must be found whole. Null and empty texts and
    items leak nothing; equal rows count once, a null id stays null; empty tables give no
    rows, other columns are not read."""
    known = items.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).distinct()
    seeds = store(_seeds(known, match), "seeds")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    suspects = store(_suspects(texts, seeds, match).withColumn("key", F.xxhash64("text")), "suspects")
    once = suspects.select("doc_id", "key", "seeds").dropDuplicates(["doc_id", "key"])
    # A few seeds, as a common prompt, may stand in most texts: no seed is gathered in one task.
    met = lookup_join(once.select("doc_id", "key", F.explode("seeds").alias("seed")), seeds, ["seed"], "inner")
    # Each place of a shared seed covers ``match`` words at most, so fewer cannot be enough.
    pairs = met.groupBy("doc_id", "key", "item_id", "n").agg(F.sum("places").alias("shared"))
    pairs = store(pairs.where(F.col("shared") * match >= F.col("n") * coverage), "pairs")
    bodies = suspects.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "text").dropDuplicates(["d", "k"])
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
    tests = known.select(F.col("item_id").alias("i"), F.col("text").alias("item"))
    rows = pairs.join(bodies, same).join(tests, F.col("item_id").eqNullSafe(F.col("i")))
    rows = rows.select("doc_id", "key", "item_id", "text", "item")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                item = tokens(row["item"])
                n, pieces = covered(item, tokens(row["text"]), match)
                if item and n >= coverage * len(item):
                    values = (row["doc_id"], row["key"], row["item_id"], len(item), n, n / len(item), pieces)
                    columns = [pa.array([v], kind) for v, kind in zip(values, _KINDS)]
                    yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return rows.mapInArrow(batches, LEAK).distinct()


_NAMES = [field.split()[0] for field in LEAK.split(", ")]
_KINDS = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.float64(), pa.int32()]


def without_leaks(docs: DataFrame, items: DataFrame, match: int = MATCH, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay."""
    found = store(leaks(docs, items, match, coverage).select(F.col("key").alias("_rs_key")).distinct(), "leaks")
    keyed = docs.withColumn("_rs_key", F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)))
    return lookup_join(keyed, found, ["_rs_key"], "left_anti").drop("_rs_key").select(*docs.columns)
