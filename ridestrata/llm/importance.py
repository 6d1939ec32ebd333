"""Resampling documents towards a target by importance weights.

Every feature, a run of words, has a bucket by hash. The buckets of all documents and of
all target texts are counted; the gain of a bucket is the log ratio of its smoothed
shares, and a document's weight is the sum of its features' gains, looked up in one
array. Weights plus noise of the Gumbel distribution, drawn from a digest of the id, rank
the documents, so the highest scores are a sample without replacement by weight.

The cutoff is found without sorting all scores. A quantile sketch gives a bracket around
the score of the last drawn place; exact counts of the scores above and inside tell
whether the place lies in it, and widen it until it does. Only the rows of the bracket are
sorted, by ranges, to find the cutoff row. Drawn rows are then ranked by ranges too: each
range counts its rows, and a row's rank is its place in its range after the ranges before.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256
from operator import or_
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.operators.stored import store

REMEMBERED = 500_000  #: features whose bucket a worker remembers
FOLDED = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32 for byte in range(256)
)  #: letters A-Z in lower case, other letters, digits and bytes beyond ASCII as they are, a blank for the rest
ORDER = ["score", "doc_id", "n_features", "weight"]


@dataclass(frozen=True)
class Sampling:
    """Features are all runs of 1 to ``longest`` words in ``buckets`` buckets; of the
    documents with at least ``least_words`` words ``percent`` in a hundred are drawn."""

    buckets: int = 10_000
    longest: int = 1
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    accuracy: int = 2_000  #: of the sketch: its error is one part of so many


class Buckets(dict):
    """Buckets by feature, worked out once for each."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = crc32(feature) % self.buckets
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


@lru_cache(maxsize=4)
def _memory(buckets: int) -> Buckets:
    return Buckets(buckets)


def bucketed(text: bytes, sampling: Sampling) -> tuple[int, list[int]]:
    """The number of words of a text in UTF-8, and the bucket of each feature."""
    words = text.translate(FOLDED).split()
    bucket = _memory(sampling.buckets).__getitem__
    found = list(map(bucket, words))
    for length in range(2, sampling.longest + 1):
        found += [bucket(b" ".join(words[at : at + length])) for at in range(len(words) - length + 1)]
    return len(words), found


def bucket_counts(texts: DataFrame, sampling: Sampling) -> np.ndarray:
    """Features of all whole texts by bucket. Each task sends one row per bucket at most."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(sampling.buckets, np.int64)
        for batch in rows:
            for row in range(0, batch.num_rows, 256):
                found: list[int] = []
                for text in batch.slice(row, 256)["text"].to_pylist():
                    found += bucketed(text or b"", sampling)[1]
                counts += np.bincount(np.array(found, np.int64), minlength=sampling.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    totals = rows.mapInArrow(batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(sampling.buckets, np.int64)
    for row in totals.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down."""
    buckets = len(raw)
    all_raw, all_target = float(raw.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(raw.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * all_raw / ((s + 1) * all_target))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of an id in thousandths, rounded down; a null id counts as the text ``null``."""
    name = "null" if doc_id is None else doc_id
    drawn = int(sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, sampling: Sampling) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) per row of ``docs``, from whole texts."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                found = [bucketed(text or b"", sampling) for text in part["text"].to_pylist()]
                sizes = np.array([len(features) for _, features in found], np.int64)
                values = gain[np.array([b for _, features in found for b in features], np.int64)]
                weights = _sums(values, sizes)
                drawn = np.array([noise(doc_id, sampling.seed) for doc_id in part["doc_id"].to_pylist()], np.int64)
                words = pa.array([n for n, _ in found], pa.int64())
                columns = [part["doc_id"], words, pa.array(sizes), pa.array(weights), pa.array(weights + drawn)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, n_words long, n_features long, weight long, score long")


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact sums of consecutive stretches of whole numbers."""
    ends = np.cumsum(np.concatenate([[0], values]))
    last = np.cumsum(sizes)
    return ends[last] - ends[last - sizes]


def _sorting() -> list[Column]:
    """Highest score first, then the smaller doc_id; a null id comes last."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]


def _not_after(row: dict) -> Column:
    """Whether a row is at or before this one in the order."""
    score, doc_id, n, weight = (row[name] for name in ORDER)
    before, same = F.col("score") > score, F.col("score") == score
    if doc_id is None:
        found = [before, same & F.col("doc_id").isNotNull()]
        same = same & F.col("doc_id").isNull()
    else:
        found = [before, same & (F.col("doc_id") < doc_id)]
        same = same & (F.col("doc_id") == doc_id)
    found += [same & (F.col("n_features") < n), same & (F.col("n_features") == n) & (F.col("weight") <= weight)]
    return F.coalesce(reduce(or_, found), F.lit(False))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in the order of the scores, without gathering them:
    rows are dealt by ranges, ranges count their rows, and a row's rank is its place in its
    range behind the ranges before. The driver holds one count per range."""
    dealt = rows.repartitionByRange(*_sorting()).sortWithinPartitions(*_sorting())
    dealt = store(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    # A row's place in its range: ids of a partition are numbered on from its first.
    dealt = dealt.withColumn("_place", F.col("_place").bitwiseAND((1 << 33) - 1))
    counts = {row["_range"]: row["count"] for row in dealt.groupBy("_range").count().collect()}
    before, total = [], 0
    for number in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(number, 0)
    offsets = F.get(F.array(*map(F.lit, before or [0])), F.col("_range"))
    return dealt.withColumn("rank", (offsets + F.col("_place") + 1).cast("long")).drop("_range", "_place")


def cutoff(scored: DataFrame, count: int, accuracy: int) -> dict | None:
    """The row at place ``count`` of stored scores, in order of score; None at place 0.

    A sketch of the scores gives the bracket. If the counted rows show that the place is
    outside, the bracket is widened on that side, twice as far each time, to all scores at
    last."""
    total = scored.count()
    if count <= 0 or not total:
        return None
    share, wide = 1 - count / total, 1 / accuracy
    below, above = 2 * wide, 2 * wide
    while True:
        low, high = (min(max(p, 0.0), 1.0) for p in (share - below, share + above))
        marks = scored.agg(F.percentile_approx("score", F.array(F.lit(low), F.lit(high)), accuracy)).first()[0]
        least = None if low == 0.0 else marks[0]
        most = None if high == 1.0 else marks[1]
        over = F.lit(False) if most is None else F.col("score") > most
        inside = ~over & (F.lit(True) if least is None else F.col("score") >= least)
        found = scored.agg(F.count_if(over).alias("over"), F.count_if(inside).alias("inside")).first()
        if count <= found["over"]:
            above *= 2
        elif count > found["over"] + found["inside"]:
            below *= 2
        else:
            break
    place = count - found["over"]
    return ranked(scored.where(inside).select(ORDER)).where(F.col("rank") == place).first().asDict()


def resampled(docs: DataFrame, target: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs`` (doc_id,
    text), drawn towards ``target`` (text); ``rank`` is null for rows that are not drawn.

    Null and texts without a word have no features, weight 0 and are not drawn. Ties of
    scores go to the smaller doc_id, a null id last; rows that share an id are ordered by
    their number of features and weight, and repeated rows have ranks of their own. An
    empty table gives no rows, an empty target an even one. Other columns are not read."""
    gain = gains(bucket_counts(docs, sampling), bucket_counts(target, sampling))
    scored = store(weighted(docs, gain, sampling), "scores")
    eligible = scored.where(F.col("n_words") >= sampling.least_words)
    count = sampling.percent * eligible.count() // 100
    last = cutoff(eligible, count, sampling.accuracy)
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    drawn = (F.col("n_words") >= sampling.least_words) & _not_after(last)
    ranks = ranked(scored.where(drawn))
    # Copies of the cutoff row itself may lie behind the last place.
    ranks = ranks.withColumn("rank", F.when(F.col("rank") <= count, F.col("rank")))
    return ranks.unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))
