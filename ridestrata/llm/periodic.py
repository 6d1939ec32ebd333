"""Runs: stretches of words that repeat with a period, found by block convolution.

At scale B, a power of two, the periods from B to 2B - 1 are sought. A text is cut into
blocks of B words, and each block is held against the 2B words behind it: the sums of
squared differences of word numbers, at all distances at once, come from a number
theoretic transform whose whole numbers are exact. A sum of zero is an occurrence of the
block, and its distance a seed. A run of a period in that range and at least four periods
long holds two neighbouring blocks at its distance, so seeds count in pairs; they are
extended to both sides by comparing words, which also drops blocks whose word numbers
only agree by their remainder.

What cannot hold a run is left out first: in a run every word is met again within a
period, so only blocks in stretches of such words are transformed; and what lies within a
run of a smaller period shows nothing but multiples of it. So the work stays near
n log n squared for n words, also where everything repeats.

Each text is judged by itself. Many short texts are handled as one sequence, with a word
of its own after each.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = 2013265921  #: fixed value: 15 * 2**27 + 1; 31 generates its residues
GENERATOR = 31
CELLS = 1 << 18  #: cells that are transformed together
TOGETHER = 1 << 17  #: words that are handled as one sequence
FAR = np.int64(1) << 40
RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
Words = Callable[[int | None, list[bytes]], list[bytes]]


def _roots(half: int, backward: bool) -> np.ndarray:
    """Powers of a root of unity of order 2 * half."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if backward:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(half, np.uint64)
    done = 1
    while done < half:
        powers[done : 2 * done] = powers[:done] * np.uint64(pow(root, done, PRIME)) % np.uint64(PRIME)
        done *= 2
    return powers


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform of each row; places come in bit-reversed order."""
    m, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(m, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([(a + b) % PRIME, (a + np.uint64(PRIME) - b) * _roots(half, False) % PRIME], 2)
        half //= 2
    return rows.reshape(m, size)


def _backward(rows: np.ndarray) -> np.ndarray:
    """The inverse, from bit-reversed order."""
    m, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(m, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % np.uint64(PRIME)
        rows = np.stack([(a + b) % PRIME, (a + np.uint64(PRIME) - b) % PRIME], 2)
        half *= 2
    return rows.reshape(m, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % np.uint64(PRIME)


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences of each block (m, B) and its window (m, 2B) at the
    offsets 0..B-1. Exact while B times the largest square is below ``PRIME``."""
    m, size = blocks.shape
    turned = np.zeros((m, 2 * size), np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, size + 1 :] = blocks[:, :0:-1]
    products = _backward(_forward(turned) * _forward(windows.astype(np.uint64)) % np.uint64(PRIME))[:, :size]
    squares = np.concatenate([np.zeros((m, 1), np.int64), np.cumsum(windows.astype(np.int64) ** 2, axis=1)], 1)
    own = (blocks.astype(np.int64) ** 2).sum(axis=1)
    return own[:, None] + squares[:, size : 2 * size] - squares[:, :size] - 2 * products.astype(np.int64)


def _next_distance(words: np.ndarray) -> np.ndarray:
    """How far behind each place its word stands again."""
    order = np.argsort(words, kind="stable")
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    out = np.full(len(words), FAR)
    out[order[again]] = order[again + 1] - order[again]
    return out


def _blocks(distance: np.ndarray, size: int, least: int) -> np.ndarray:
    """Numbers of the blocks in stretches of ``least`` places or more whose words are met
    again within two blocks; such a stretch must hold two blocks."""
    breaks = np.concatenate([[-1], np.flatnonzero(distance >= 2 * size), [len(distance)]])
    long = np.flatnonzero(np.diff(breaks) - 1 >= least)
    first, last = -(-(breaks[long] + 1) // size), breaks[long + 1] // size
    counts = np.where(last - first >= 2, last - first, 0)
    offsets = np.cumsum(counts) - counts
    return np.repeat(first - offsets, counts) + np.arange(counts.sum())


class _Reach:
    """How far the known runs that begin at or before a place reach."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        known = sorted((start, start + length) for start, length, _ in runs)
        self.starts = np.array([start for start, _ in known], np.int64)
        self.ends = np.maximum.accumulate(np.array([0, *(end for _, end in known)], np.int64))

    def __call__(self, places: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.starts, places, side="right")]


def _seeds(words: np.ndarray, blocks: np.ndarray, size: int, reach: _Reach) -> np.ndarray:
    """(distance, block) rows, sorted: occurrences of blocks at distances from ``size`` on,
    that also hold for the block before or behind."""
    most = int(((PRIME - 1) // size) ** 0.5) - 1
    numbers = np.append(words % most, np.full(3 * size, most))
    found = []
    rows = max(1, CELLS // (2 * size))
    for at in range(0, len(blocks), rows):
        part = blocks[at : at + rows]
        places = part[:, None] * size + np.arange(3 * size)
        cells = numbers[places]
        row, offset = np.nonzero(squared_differences(cells[:, :size], cells[:, size:]) == 0)
        distance, block = offset + size, part[row]
        open_ = reach(block * size) < block * size + size + distance
        found.append(np.stack([distance[open_], block[open_]], 1))
    seeds = np.concatenate(found)
    seeds = seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]
    follows = np.flatnonzero((seeds[1:, 0] == seeds[:-1, 0]) & (seeds[1:, 1] == seeds[:-1, 1] + 1))
    return seeds[np.union1d(follows, follows + 1)]


def _matched(words: np.ndarray, at: int, distance: int, step: int) -> int:
    """Places from ``at`` on, to the right (step 1) or left (-1), whose word stands again
    at this distance."""
    done, size = 0, 64
    while True:
        if step > 0:
            a = words[at + done : max(at + done, min(at + done + size, len(words) - distance))]
            b = words[at + done + distance : at + done + distance + len(a)]
        else:
            low = max(0, at - done - size + 1)
            a = words[low : at - done + 1][::-1]
            b = words[low + distance : at - done + 1 + distance][::-1]
        if not len(a):
            return done
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done, size = done + len(a), size * 2


def runs_of(words: np.ndarray, longest: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the stretches of at least ``least`` words and
    ``times`` periods that no neighbour extends; no text is longer than ``longest``."""
    if times < 4:
        raise ValueError("a run must be at least four periods long")
    runs: list[tuple[int, int, int]] = []
    distance, size = _next_distance(words), 1
    while times * size <= longest:
        blocks = _blocks(distance, size, max(least - 2 * size + 1, (times - 1) * size))
        reach = _Reach(runs)
        blocks = blocks[reach(blocks * size) < (blocks + 3) * size]
        extents = {(start, length) for start, length, _ in runs}
        done = (0, 0)
        for period, block in _seeds(words, blocks, size, reach).tolist() if len(blocks) else ():
            if done[0] == period and block * size < done[1]:
                continue
            right = _matched(words, block * size, period, 1)
            start = block * size - _matched(words, block * size - 1, period, -1) if right else block * size
            length = block * size + right + period - start
            done = (period, block * size + max(right, 1))
            if length >= max(least, times * period) and (start, length) not in extents:
                runs.append((start, length, period))
                extents.add((start, length))
        size *= 2
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, each followed by a number of its own, and where
    each text begins."""
    known: dict[bytes, int] = {}
    numbers: list[int] = []
    begins = []
    for text in texts:
        begins.append(len(numbers))
        numbers += [known.setdefault(word, len(known)) for word in text]
        numbers.append(-1)
    words = np.array(numbers, np.int64)
    own = np.flatnonzero(words < 0)
    words[own] = len(known) + np.arange(len(own))
    return words, np.array(begins, np.int64)


def _judged(texts: list[list[bytes]], least: int, times: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each."""
    words, begins = _numbered(texts)
    by_text: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(words, max(map(len, texts), default=0), least, times):
        text = int(np.searchsorted(begins, start, side="right")) - 1
        by_text[text].append((start - int(begins[text]), length, period))
    for text, runs in zip(texts, by_text):
        if runs:
            gone = np.zeros(len(text) + 1, np.int64)
            for start, length, period in runs:
                gone[start + period] += 1
                gone[start + length] -= 1
            text = [text[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        yield runs, b" ".join(text)


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, words: Words | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) per row of ``docs`` (doc_id, text): the runs of each whole
    text by start and period, and its words without those that a run holds behind its
    first period. Places are word numbers from 0; words end at ASCII white space.
    ``words(doc_id, words)`` may give the words to judge in place of the text's own.

    Null, empty and blank texts have no runs and collapse to the empty text. Runs of
    different periods may overlap. Repeated rows come back repeated, a null doc_id stays
    null, an empty table gives no rows; other columns are not read. A text is held by one
    task as a whole."""

    def judged(rows: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        found = list(_judged([text for _, text in rows], least, times))
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in text] for text, _ in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        collapsed = pa.array([text for _, text in found], pa.binary()).cast(pa.string())
        columns = [pa.array([doc_id for doc_id, _ in rows], pa.int64()), pa.array(runs, kind), collapsed]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[bytes]]] = []
        size = 0
        for batch in rows:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_id, own = doc_id.as_py(), (text.as_py() or b"").split()
                held.append((doc_id, words(doc_id, own) if words else own))
                size += len(held[-1][1])
                if size >= TOGETHER:
                    yield judged(held)
                    held, size = [], 0
        if held:
            yield judged(held)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(batches, RUNS)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; of equal ones the
    first by start and period. Null without a run."""
    return F.when(
        F.size(runs) > 0,
        F.reduce(runs, runs[0], lambda best, run: F.when(run.length * best.period > best.length * run.period, run).otherwise(best)),
    )


def run_lines(runs: Column) -> Column:
    """``start,length,period`` of every run, each with a line feed."""
    lines = F.transform(runs, lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    return F.array_join(lines, "")
