"""Substring dedup by anchors and hashed names of their contexts.

No suffixes are put in order and no bucket pointers are refined. Names reach no deeper
than a window of ``WIDTH`` bytes. The initial
buckets are the 8-grams themselves; the bucket of twice the depth follows from the
identifiers at a place and at the place one depth later, and each deeper identifier
is built from the deeper ones before it, down to the whole window. Only suffixes
that start at an anchor are named: of the places of a window, the one whose 16-gram
bucket has the least identifier. Spark groups their buckets by the
identifiers of all later and earlier offsets that a window can reach
(``ridestrata.llm.repeats``)."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.llm.repeats import CROWD, Units, later, merged, name, repeated_spans, with_spans

WIDTH = 50
QGRAM = 16
#: No bucket counts as hot: each row of one would become up to 35 windows, too many to
#: shuffle. A bucket of more than ``CROWD`` rows is still not held by its task.
HOT = 1.0


def _bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, dtype=np.uint8)


def _eight_grams(array: np.ndarray) -> tuple[np.ndarray, int]:
    body = array.tobytes() + bytes(8)
    return np.ndarray(len(array), dtype="<u8", buffer=body, strides=(1,)).copy(), 8


def _earlier(values: np.ndarray, by: int) -> np.ndarray:
    moved = np.zeros_like(values)
    if by < len(values):
        moved[by:] = values[: len(values) - by]
    return moved


def _over(values: np.ndarray, size: int, best, shift) -> np.ndarray:
    """The best of ``size`` values at and beside each place."""
    reach = 1
    while 2 * reach <= size:
        values = best(values, shift(values, reach))
        reach *= 2
    return best(values, shift(values, size - reach)) if reach < size else values


def _least_buckets(array: np.ndarray, inside: np.ndarray, width: int):
    grams, _ = _eight_grams(array)
    buckets = name(grams, later(grams, QGRAM - 8))
    # The name of NULs is zero, which stands for no bucket below.
    buckets[buckets == 0] = 1
    places = width - QGRAM + 1
    least = np.where(inside, _over(buckets, places, np.minimum, later), np.uint64(0))
    at = np.flatnonzero((_over(least, places, np.maximum, _earlier) == buckets) & (buckets != 0))
    return at, np.full(len(at), QGRAM, dtype=np.int64), buckets[at]


def byte_units(width: int = WIDTH) -> Units:
    if width < QGRAM:
        raise ValueError(f"a window has {QGRAM} bytes at least")
    return Units(width, "u1", 0xFF, _bytes, _eight_grams, _least_buckets)


CUT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def without_repeats(
    docs: DataFrame, width: int = WIDTH, crowd: int = CROWD, whole: bool = False, hot: float = HOT
) -> DataFrame:
    """``docs`` with a column ``_rs_cut`` (n_bytes, n_removed, n_spans, kept): each text
    without the bytes covered by a string of ``width`` bytes that also starts in a
    text with a smaller doc_id. With ``whole``, a character of which a byte goes is left
    out of ``kept`` altogether.

    Null texts count as empty. Repeated rows get the same result each. Rows without
    doc_id are left whole and cover nothing. Of different texts under one doc_id one
    is judged, the others are left whole. An empty table gives no rows; other columns
    are passed on."""

    def kept(text: bytes, starts: np.ndarray, stops: np.ndarray, copy: bool) -> tuple:
        n = len(text)
        if copy and n >= width:
            return n, n, 1, b""
        starts, stops = merged(starts, stops, n)
        cuts = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), n]
        parts = [text[a:b] for a, b in zip(cuts[::2], cuts[1::2])]
        removed = n - sum(map(len, parts))
        if whole:
            parts = [part.decode(errors="ignore").encode() for part in parts]
        return n, removed, len(starts), b"".join(parts)

    return with_spans(docs, repeated_spans(docs, byte_units(width), False, crowd, hot), kept, CUT)


def suffix_dedup(docs: DataFrame, width: int = WIDTH, crowd: int = CROWD, hot: float = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, and the bytes kept."""
    cut = without_repeats(docs.select("doc_id", "text"), width, crowd, hot=hot)
    return cut.select("doc_id", "_rs_cut.*")


def with_kept_text(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with their texts cut and n_chars, where present, counted anew. A
    character of which a byte was removed goes as a whole; null texts stay null."""


    kept = F.col("_rs_cut.kept").cast("string")
    text = F.when(F.col("_rs_cut.n_removed") > 0, kept).otherwise(F.col("text"))
    cut = without_repeats(docs, width, whole=True).withColumn("text", text)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)
