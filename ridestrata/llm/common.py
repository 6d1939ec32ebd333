"""Helpers shared by the text operators."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.operators.stored import lookup_join, store

#: White space of the word rule: every byte or character outside it belongs to a word.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; true without an id,
    so that nothing is learned from such a row."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(True))


def bounded_sample(
    rows: DataFrame,
    label: str,
    per_label: int,
    max_chars: int,
    labels: DataFrame | None = None,
    most_labels: int = 100_000,
    most_chars: int = 400_000_000,
) -> list[dict]:
    """At most ``per_label`` rows of each label, texts of up to ``max_chars`` characters,
    on the driver, by label. Rows are picked by a hash of id and text, so the same table
    always gives the same sample; the bounds are the caller's. ``labels`` has (doc_id,
    label) if ``rows`` have no label; a row with several is sampled for each.

    Texts are read twice, however many labels there are, and do not move: once for their
    hashes, which meet the labels and are stored, and once for those that are picked. Of
    each label somewhat more hashes than are wanted lie below its bound, a tenth and four
    deviations; Spark keeps the first. More labels than ``most_labels``, or a sample of more
    characters than ``most_chars``, is an error."""
    order = F.xxhash64("doc_id", "text", F.lit(11)).alias("_rs_order")
    eligible = rows.where(F.length("text") <= max_chars).select("*", order)
    hashes = eligible.select("doc_id", *([label] if labels is None else []), "_rs_order", F.length("text").alias("_rs_chars"))
    if labels is not None:
        hashes = hashes.join(labels.select("doc_id", label), "doc_id")
    hashes = store(hashes.where(F.col(label).isNotNull()).select(label, "_rs_order", "_rs_chars"), "sample-hashes")
    sizes = hashes.groupBy(label).agg(F.count("*").alias("n"), F.sum("_rs_chars").alias("chars"))
    counts = sizes.limit(most_labels + 1).collect()
    if len(counts) > most_labels:
        raise ValueError(f"more than {most_labels} values of {label}; name a bound that the driver can hold")
    chars = sum(found["chars"] * min(1.0, per_label / found["n"]) for found in counts)
    if chars > most_chars:
        raise ValueError(f"a sample of {chars:.0f} characters is larger than {most_chars}; take fewer rows of each {label}")
    if not counts:
        return []
    bounds, wanted = [], per_label * 1.1 + 4 * per_label**0.5
    for found in counts:
        share = min(1.0, wanted / found["n"])
        bounds.append((found[label], min(int((share * 2 - 1) * 2.0**63), 2**63 - 1)))
    schema = T.StructType([hashes.schema[label], T.StructField("_rs_bound", T.LongType())])
    limits = F.broadcast(rows.sparkSession.createDataFrame(bounds, schema))
    place = F.row_number().over(Window.partitionBy(label).orderBy("_rs_order")).alias("_rs_place")

    def first(near: DataFrame) -> DataFrame:
        return near.select("*", place).where(F.col("_rs_place") <= per_label).drop("_rs_place")

    near = hashes.join(limits, label).where("_rs_order <= _rs_bound").select(label, "_rs_order")
    picked = store(first(near).distinct(), "sampled")
    key = ["_rs_order"] if labels is not None else ["_rs_order", label]
    taken = first(lookup_join(eligible, picked, key, "inner")).collect()
    taken.sort(key=lambda row: (row[label], row["_rs_order"]))
    return [{name: row[name] for name in (*rows.columns, *([label] if labels is not None else []))} for row in taken]


def segment_sums(values: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Sums of consecutive segments of these lengths, zero for empty ones."""
    lengths = np.asarray(lengths, dtype=np.int64)
    out = np.zeros((len(lengths), *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(lengths)
    if len(full):
        starts = (np.cumsum(lengths) - lengths)[full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
