"""Substring and word-window dedup against brute force, and their odd cases."""

import random
from hashlib import sha256

import numpy as np
import pytest

from ridestrata.llm.recompression import recompression_dedup, word_units
from ridestrata.llm.suffix_dedup import byte_units, suffix_dedup, with_kept_text
from tests.llm.brute import substring_rows, window_rows

SCHEMA = "doc_id long, text string"


def corpus(seed: int, count: int = 120) -> list[tuple[int, str]]:
    """Texts from few words, so that repeats, runs and overlaps abound."""
    rng = random.Random(seed)
    words = ["a", "b", "é", "the", "von", "ñandú", "x1", "-"]
    shared = [" ".join(rng.choices(words, k=40)) for _ in range(6)]
    texts = []
    for _ in range(count):
        kind = rng.randrange(7)
        text = " ".join(rng.choices(words, k=rng.randrange(0, 60)))
        if kind == 0:
            text = rng.choice(shared)
        elif kind == 1:
            text = f"{text} {rng.choice(shared)} {text[:30]}"
        elif kind == 2:
            text = " ".join(["run"] * rng.randrange(1, 90)) + text
        elif kind == 3 and texts:
            text = rng.choice(texts).replace("the", "thy", 1)
        elif kind == 4 and texts:
            text = rng.choice(texts)
        elif kind == 5:
            text = f"{rng.choice(shared)}\n{rng.choice(shared)}\t{rng.choice(shared)}"
        texts.append(text)
    ids = rng.sample(range(-50, 1000), count)
    return list(zip(ids, texts))


def digests(rows):
    return sorted((tuple(r)[:-1] + (sha256(bytes(r[-1]) if not isinstance(r[-1], str) else r[-1].encode()).hexdigest(),) for r in rows), key=str)


LIMITS = [(20_000, 0.001), (20_000, 0.00008), (3, 0.001), (1, 0.0002)]


@pytest.mark.parametrize("seed,width,limits", [*zip((1, 2, 3, 4), (50, 24, 50, 30), LIMITS)])
def test_substrings(spark, seed, width, limits):
    docs = corpus(seed)
    found = suffix_dedup(spark.createDataFrame(docs, SCHEMA).repartition(5), width, *limits)
    assert digests(found.collect()) == substring_rows(docs, width)


@pytest.mark.parametrize("parts", [1, 200])
def test_runs_of_nul_bytes(spark, parts):
    """NULs at the start, inside and at the end, alone and with tails; also with one text
    per task, where a task has no anchor."""
    nul, docs = "\0", []
    for number, run in enumerate((15, 16, 17, 40, 49, 50, 51, 60, 80)):
        tail = f" shared tail {run} of some more letters"
        body = nul * run
        for text in (body + tail, f"alpha {body} beta {number}", f"gamma {body} delta {number}", tail + body, body, "x" * 60 + body):
            docs.append((len(docs), text))
    found = suffix_dedup(spark.createDataFrame(docs, SCHEMA).repartition(parts), 50)
    assert digests(found.collect()) == substring_rows(docs, 50)
    few = [(1, nul * 60), (2, nul * 70), (3, "short"), (4, f"a{nul * 60}")]
    found = suffix_dedup(spark.createDataFrame(few, SCHEMA).repartition(parts), 50)
    assert digests(found.collect()) == substring_rows(few, 50)


@pytest.mark.parametrize("seed,width,limits", [*zip((5, 6, 7, 8), (20, 8, 20, 5), LIMITS)])
def test_windows(spark, seed, width, limits):
    docs = corpus(seed)
    found = recompression_dedup(spark.createDataFrame(docs, SCHEMA).repartition(5), width, *limits)
    assert digests(found.collect()) == window_rows(docs, width)


LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [(1, LONG), (2, LONG), (2, LONG), (3, None), (4, ""), (5, " \t\n"), (None, LONG), (6, "short")]


def test_odd_rows(spark):
    extra = [(i, t, "k", 1, 2, 3) for i, t in ODD]
    frame = spark.createDataFrame(extra, f"{SCHEMA}, bucket string, n_bytes int, start int, stop int")
    assert digests(suffix_dedup(frame).collect()) == substring_rows(ODD, 50)
    assert digests(recompression_dedup(frame).collect()) == window_rows(ODD, 20)


@pytest.mark.parametrize("limits", [(20_000, 0.001), (1, 0.00004)])
def test_repeated_rows(spark, limits):
    long = [" ".join(f"{p}{i % 50}" for i in range(70)) for p in "pqr"]
    docs = [(1, long[0]), (1, long[0]), (2, f"{long[1]} {long[0]}"), (3, long[2]), (5, long[1])] + [(4, f"x {long[2]}")] * 4
    for parts in (1, 5):
        frame = spark.createDataFrame(docs, SCHEMA).repartition(parts)
        assert digests(recompression_dedup(frame, 20, *limits).collect()) == window_rows(docs, 20)
        assert digests(suffix_dedup(frame, 50, *limits).collect()) == substring_rows(docs, 50)


def test_texts_that_share_an_id(spark):
    one, two = " ".join(f"p{i}" for i in range(40)), " ".join(f"q{i}" for i in range(40))
    frame = spark.createDataFrame([(1, one), (2, one), (2, two), (3, two)], SCHEMA)
    found = {(r["doc_id"], r["n_removed"] > 0) for r in suffix_dedup(frame).collect()}
    assert (1, False) in found and len(suffix_dedup(frame).collect()) == 4
    assert recompression_dedup(frame).count() == 4


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup(empty).count() == 0
    assert recompression_dedup(empty).count() == 0


def test_kept_text_keeps_columns_and_whole_characters(spark):
    shared = "é" * 40
    # The first byte of ñ is that of é and goes with the string before it.
    rows = [(1, "ab" + shared, "en", 9), (2, shared + "ñz", "es", 9), (3, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    found = {r["doc_id"]: r for r in with_kept_text(frame).collect()}
    assert with_kept_text(frame).columns == frame.columns
    assert found[1]["text"] == "ab" + shared and found[2]["text"] == "z" and found[2]["n_chars"] == 1
    assert found[3]["text"] is None


@pytest.mark.parametrize("hot", [0.00004, 0.0001, 0.001])
def test_buckets_over_many_batches(spark, hot):
    docs = corpus(9)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert digests(suffix_dedup(frame, 30, 4, hot).collect()) == substring_rows(docs, 30)
        assert digests(recompression_dedup(frame, 8, 4, hot).collect()) == window_rows(docs, 8)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("units", [byte_units(30), word_units(8)])
def test_second_names_tell_windows_apart(units):
    """Equal windows have both names alike, and neither name is a function of the other's."""
    rng = np.random.default_rng(3)
    array = np.tile(rng.integers(1, 200, 400).astype(units.dtype), 2)
    first, second = units.windows(array), units.windows(array, other=True)
    inside = np.arange(400 - units.width)
    assert (first[inside] == first[inside + 400]).all() and (second[inside] == second[inside + 400]).all()
    assert len(np.unique(second[inside])) == len(inside)
    assert not (first[inside] == second[inside]).any()
