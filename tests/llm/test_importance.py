"""Importance resampling against a plain version and SQL."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from ridestrata.llm.importance import Sampling, cutoff, ranked, resampled
from ridestrata.llm.queries import ORACLE, QUERIES, with_library
from ridestrata.operators.stored import store
from tests.compare import difference, duckdb_over


def plain_features(text, longest):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, sampling):
    def bucket(feature):
        return crc32(feature.encode()) % sampling.buckets

    raw = Counter(bucket(f) for _, text in docs for f in plain_features(text, sampling.longest)[1])
    aim = Counter(bucket(f) for text in target for f in plain_features(text, sampling.longest)[1])
    size = sampling.buckets
    over = [(aim[b] + 1) * (sum(raw.values()) + float(size)) / ((raw[b] + 1) * (sum(aim.values()) + float(size))) for b in range(size)]
    rows = []
    for doc_id, text in docs:
        n, found = plain_features(text, sampling.longest)
        weight = sum(math.floor(1000 * math.log(over[bucket(f)])) for f in found)
        h = int(sha256(f"{sampling.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted(
        (row for row in rows if row[1] >= sampling.least_words),
        key=lambda row: (-row[4], row[0] is None, row[0] or 0, row[2], row[3]),
    )
    for place, row in enumerate(order[: sampling.percent * len(order) // 100]):
        row.append(place + 1)
    return [tuple(row) if len(row) == 6 else (*row, None) for row in rows]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_like_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    assert difference(QUERIES["op11_importance"](spark, sf), duckdb_over(sf), ORACLE["op11_importance"]) is None


def test_odd_rows_and_ties(spark):
    with_library(spark)
    rng = random.Random(4)
    words = ["Red", "blue", "GREEN", "é", "中文", "x9", "a-b", "\x00", "İ", "ſt"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(300)]
    docs += [(7, "blue blue blue red")] * 25 + [(None, "blue red x9 green")] * 9 + [(7, None), (400, ""), (401, "Ab " * 50_000)]
    target = ["blue RED é", None, "blue blue", ""]
    frame = spark.createDataFrame([(i, t, "z", 1) for i, t in docs], "doc_id long, text string, score string, rank int")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for sampling in (Sampling(50, 1, 3, 30), Sampling(50, 2, 1, 100, accuracy=10), Sampling(50, 3, 4, 1, seed=9)):
        found = sorted(map(tuple, resampled(frame, aim, sampling).collect()), key=str)
        assert found == sorted(plain(docs, target, sampling), key=str)
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert resampled(nothing, aim).count() == 0
    even = resampled(frame, nothing, Sampling(50, 1, 3, 30)).collect()
    assert sorted(map(tuple, even), key=str) == sorted(plain(docs, [], Sampling(50, 1, 3, 30)), key=str)


def test_bracket_widens_to_the_place(spark):
    """A sketch of low accuracy, long ties and every place."""
    rng = random.Random(5)
    rows = [(i, 1, 1, rng.choice([0, 5, 5, 5, rng.randrange(1000)])) for i in range(2_000)]
    scored = store(spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long"), "scored")
    order = sorted(rows, key=lambda row: (-row[3], row[0]))
    for place in (1, 2, 500, 1200, 1999, 2000):
        found = cutoff(scored, place, accuracy=3)
        assert (found["doc_id"], found["score"]) == (order[place - 1][0], order[place - 1][3])
    assert cutoff(scored, 0, 3) is None
    places = {row["doc_id"]: row["rank"] for row in ranked(scored).collect()}
    assert [places[row[0]] for row in order] == list(range(1, 2001))
    assert ranked(scored.where(F.lit(False))).count() == 0
