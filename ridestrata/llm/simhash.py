"""SimHash near-duplicates by segment popcounts.

A fingerprint is embedded as the number of set bits in each of 32 two-bit
segments. A differing bit moves one of these counts by one, so the Manhattan
distance of two embeddings never exceeds the Hamming distance of the
fingerprints. The coordinates are cut into ``distance + 3`` groups: two points
within the distance agree in three groups at least, so they meet in the grid cell
named by the counts of those three groups. Inside a cell the Manhattan distance
drops most pairs and the exact bit count decides the rest.

Only distinct fingerprints enter the grid, and a cell gives the edges of a
spanning forest, not its pairs. A cell with more than ``CELL`` members is handed
on and cut finer: first by the exact bits of its three groups, then by three
groups of the bits that are left, after which at most 2**16 fingerprints can be
alike. No step depends on a cap and no group is held by more than that bound.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestrata.llm.graph import components
from ridestrata.operators.stored import lookup_join, store

CELL = 1024
BITS = 64
_EVEN = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the hashes of all word shingles; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(gram, seed) for gram in grams], dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 8192):
        block = hashes[start : start + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(majority.tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): a fingerprint per row, as a signed long."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [fingerprint(text.as_py(), shingle, seed) for text in batch["text"]]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(signed)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, fp long"
    )


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The 32 two-bit popcounts, packed two bits each into one word."""
    return (fp & _EVEN) + ((fp >> np.uint64(1)) & _EVEN)


def _groups(bits: list[int], parts: int) -> list[np.uint64]:
    """Masks of ``parts`` groups of these bit positions, even positions kept with
    the odd ones above them."""
    pairs = [bits[i : i + 2] for i in range(0, len(bits), 2)]
    return [
        np.uint64(sum(1 << bit for pair in part for bit in pair))
        for part in (pairs[i * len(pairs) // parts : (i + 1) * len(pairs) // parts] for i in range(parts))
    ]


def _trios(distance: int) -> list[np.uint64]:
    """For each choice of three of the groups the mask of their bits."""
    groups = _groups(list(range(BITS)), distance + 3)
    return [a | b | c for a, b, c in combinations(groups, 3)]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the differences of packed two-bit counts."""
    total = np.zeros(np.broadcast_shapes(a.shape, b.shape), dtype=np.int16)
    low = np.uint64(0x3333333333333333)
    for shift in (np.uint64(0), np.uint64(2)):
        # Counts are spread to four bits; adding 4 keeps each difference positive.
        x = ((a >> shift) & low) + np.uint64(0x4444444444444444) - ((b >> shift) & low)
        # Offsets 2..6 stand for -2..2; their distance from 4 in bits.
        away = x ^ np.uint64(0x4444444444444444)
        one = away & np.uint64(0x1111111111111111)
        two = (away >> np.uint64(1)) & np.uint64(0x1111111111111111) & ~one
        total += _popcount(one).astype(np.int16) + 2 * _popcount(two).astype(np.int16)
    return total


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between these fingerprints."""
    n = len(fp)
    counts, parent = segment_counts(fp), np.arange(n)
    left, right = [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for start in range(0, n, 256):
        part = slice(start, min(start + 256, n))
        later = slice(start + 1, n)
        near = _manhattan(counts[part, None], counts[None, later]) <= distance
        rows, cols = np.nonzero(near)
        rows, cols = rows + start, cols + start + 1
        ahead = cols > rows
        rows, cols = rows[ahead], cols[ahead]
        exact = _popcount(fp[rows] ^ fp[cols]) <= distance
        for i, j in zip(rows[exact].tolist(), cols[exact].tolist()):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(j)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _cells(points: DataFrame, distance: int) -> DataFrame:
    """(cell, part, fp): each fingerprint once per choice of three groups. ``cell``
    has the popcounts of the chosen groups, ``part`` their exact bits."""
    masks = _trios(distance)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = frame["fp"].to_numpy().view(np.uint64)
            counts = segment_counts(fp)
            for choice, mask in enumerate(masks):
                yield pd.DataFrame(
                    {
                        "choice": np.full(len(fp), choice, dtype=np.int32),
                        "cell": (counts & mask).view(np.int64),
                        "part": (fp & mask).view(np.int64),
                        "fp": fp.view(np.int64),
                    }
                )

    return points.mapInPandas(spread, "choice int, cell long, part long, fp long")


def _finer(crowded: DataFrame, distance: int) -> DataFrame:
    """Members of crowded parts once per choice of three groups of the bits that
    their first choice left open."""
    masks = _trios(distance)
    inner = []
    for mask in masks:
        rest = [bit for bit in range(BITS) if not int(mask) >> bit & 1]
        groups = _groups(rest, distance + 3)
        inner.append([mask | a | b | c for a, b, c in combinations(groups, 3)])

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for choice, rows in frame.groupby("choice"):
                fp = rows["fp"].to_numpy().view(np.uint64)
                for number, mask in enumerate(inner[choice]):
                    key = (fp & mask).view(np.int64)
                    yield pd.DataFrame(
                        {
                            "choice": np.full(len(fp), choice * len(masks) + number, dtype=np.int32),
                            "cell": key,
                            "part": key,
                            "fp": fp.view(np.int64),
                        }
                    )

    return crowded.mapInPandas(spread, "choice int, cell long, part long, fp long")


def _links(cells: DataFrame, distance: int, last: bool, limit: int) -> DataFrame:
    """(a, b, choice): edges within cells. A part with more than ``limit`` members
    comes back as rows without ``b``, unless this is the last level."""

    def settle(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = forest(fp.view(np.uint64), distance)
        return fp[i], fp[j]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, flood = [], None
        for frame in frames:
            rows = pd.concat([*held, frame])
            held = []
            if flood is not None:
                same = (rows[["choice", "cell", "part"]].to_numpy() == flood).all(axis=1)
                yield crowded(rows[same])
                rows = rows[~same]
                if not len(rows):
                    continue
                flood = None
            choice, cell, part = (rows[c].to_numpy() for c in ("choice", "cell", "part"))
            # All cells but the last are complete; of a crowded one, all parts but the last.
            open_ = (choice == choice[-1]) & (cell == cell[-1])
            if open_.sum() > limit:
                open_ &= part == part[-1]
            yield from settled(rows[~open_])
            if open_.sum() > limit and not last:
                flood = np.array([choice[-1], cell[-1], part[-1]])
                yield crowded(rows[open_])
            else:
                held = [rows[open_]]
        if held:
            yield from settled(held[0])

    def crowded(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": rows["fp"], "b": np.int64(0), "choice": rows["choice"]})

    def settled(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        choice, cell, part, fp = (rows[c].to_numpy() for c in ("choice", "cell", "part", "fp"))
        new_cell = np.r_[True, (choice[1:] != choice[:-1]) | (cell[1:] != cell[:-1])]
        new_part = new_cell | np.r_[True, part[1:] != part[:-1]]
        starts = np.flatnonzero(new_cell)
        ends = np.r_[starts[1:], len(fp)]
        a, b, c = [], [], []

        def take(lo: int, hi: int) -> None:
            if hi - lo < 2:
                return
            if hi - lo > limit and not last:
                a.append(fp[lo:hi])
                b.append(np.zeros(hi - lo, dtype=np.int64))
                c.append(choice[lo:hi])
                return
            i, j = settle(fp[lo:hi])
            a.append(i)
            b.append(j)
            c.append(np.full(len(i), -1, dtype=np.int32))

        for lo, hi in zip(starts.tolist(), ends.tolist()):
            if hi - lo <= limit:
                take(lo, hi)
                continue
            cuts = np.flatnonzero(new_part[lo:hi]) + lo
            for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), hi]):
                take(x, y)
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "choice": np.concatenate(c)})

    order = ["choice", "cell", "part", "fp"]
    return (
        cells.repartition("choice", "cell")
        .sortWithinPartitions(*order)
        .mapInPandas(batches, "a long, b long, choice int")
    )


def fingerprint_links(points: DataFrame, distance: int = 3, limit: int = CELL) -> DataFrame:
    """(a, b): edges between distinct fingerprints that connect exactly those within
    ``distance`` bits, directly or over others."""
    first = store(_links(_cells(points, distance), distance, False, limit), "links")
    crowded = first.where("choice >= 0")
    finer = _finer(crowded.select("choice", F.col("a").alias("fp")), distance)
    second = _links(finer, distance, True, limit)
    return first.where("choice < 0").unionByName(second).select("a", "b").distinct()


def _grouped(docs: DataFrame, shingle: int, seed: int, distance: int, limit: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of ``docs``. ``root`` names the
    group, ``component_id`` need not where groups share an id."""
    marked = store(fingerprints(docs, shingle, seed), "fingerprints")
    points = store(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    classes = components(fingerprint_links(points.select("fp"), distance, limit))
    # Only fingerprints that have a link are in ``classes``.
    rooted = points.join(classes, points["fp"] == classes["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")
    return lookup_join(marked, named, ["fp"])


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, seed: int = 42, distance: int = 3, limit: int = CELL
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Repeated
    rows come back repeated. A row without doc_id links its group too, but only
    ids count for ``component_id``, which is null where a group has none. An empty
    table gives no rows; other columns than doc_id and text are not read."""
    grouped = _grouped(docs, shingle, seed, distance, limit)
    return grouped.select("doc_id", _hex("fp").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest id
    stays, once, and of several with that id the one with the least fingerprint. Rows
    without an id stay only where their group has no id, all of them, since nothing
    tells them apart."""
    found = store(_grouped(docs, shingle, 42, distance, CELL), "near-copies")
    leads = F.max(F.col("doc_id") == F.col("component_id")).alias("leads")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("copies"), leads)
    ids = store(ids.where("leads").select("doc_id", "copies"), "kept-ids")
    kept = lookup_join(docs, ids.where("copies = 1").select("doc_id"), ["doc_id"], "left_semi")
    # The id of several rows does not tell which of them leads a group.
    if not ids.where("copies > 1").isEmpty():
        shared = store(ids.where("copies > 1").select("doc_id"), "shared-ids")
        first = lookup_join(found.where("doc_id = component_id"), shared, ["doc_id"], "left_semi")
        first = first.groupBy("root", "doc_id").agg(F.min("fp").alias("fp"))
        first = store(first.select("doc_id", _hex("fp").alias("_rs_fp")), "leads")
        several = lookup_join(docs, shared, ["doc_id"], "left_semi")
        several = several.withColumn("_rs_fp", _hex_fingerprint(shingle)("text"))
        several = lookup_join(several, first, ["doc_id", "_rs_fp"], "left_semi")
        place = F.row_number().over(Window.partitionBy("doc_id", "_rs_fp").orderBy(F.xxhash64("text")))
        several = several.withColumn("_rs_place", place).where("_rs_place = 1")
        kept = kept.unionByName(several.drop("_rs_place", "_rs_fp"))
    # An id-less row stays only if its own group has no id.
    lone = found.where("component_id IS NULL").select(_hex("fp").alias("_rs_fp")).distinct()
    if not lone.isEmpty():
        idless = docs.where("doc_id IS NULL")
        marked = idless.withColumn("_rs_fp", _hex_fingerprint(shingle)("text"))
        kept = kept.unionByName(marked.join(lone, "_rs_fp", "left_semi").drop("_rs_fp"))
    return kept


def _hex_fingerprint(shingle: int):
    @F.pandas_udf("string")
    def hexed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: f"{fingerprint(text, shingle):016x}")

    return hexed
