"""Periodic runs against a plain search of every stretch."""

import random
import time
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from ridestrata.llm.periodic import periodic_runs, runs_of, squared_differences
from ridestrata.llm.queries import QUERIES, with_library

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    """All runs, by comparing the words of every distance."""
    extents, n = {}, len(words)
    for period in range(1, n // times + 1):
        at = 0
        while at < n - period:
            if words[at] != words[at + period]:
                at += 1
                continue
            end = at
            while end < n - period and words[end] == words[end + period]:
                end += 1
            length = end + period - at
            if length >= max(least, times * period):
                extents.setdefault((at, length), period)
            at = end
    return sorted(((s, n, p) for (s, n), p in extents.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, words):
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    collapsed = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, sha256(lines.encode()).hexdigest(), sha256(collapsed).hexdigest())


def test_squared_differences_are_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        most = int((2013265920 // size) ** 0.5)
        blocks, windows = rng.integers(0, most, (5, size)), rng.integers(0, most, (5, 2 * size))
        plain = [[((b - w[e : e + size]) ** 2).sum() for e in range(size)] for b, w in zip(blocks, windows)]
        assert squared_differences(blocks, windows).tolist() == np.array(plain).tolist()


def repetitive(rng):
    kind, n = rng.randrange(6), rng.randrange(1, 160)
    letters = rng.choice([1, 2, 3, 30])
    words = [rng.randrange(letters) for _ in range(n)]
    if kind == 1:
        words = words[: rng.randrange(1, 20)] * rng.randrange(2, 9)
    elif kind == 2:
        unit = words[: rng.randrange(1, 8)]
        words = words[:9] + unit * rng.randrange(3, 8) + unit[: rng.randrange(len(unit) + 1)] + words[:30]
    elif kind == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        words = b
    elif kind == 4:
        m = rng.randrange(1, 40)
        words = ([0] * m + [1]) * rng.randrange(1, 6) + [0] * m
    elif kind == 5:
        inner = words[: rng.randrange(1, 5)] * rng.randrange(4, 6) + [99]
        words = inner * rng.randrange(3, 6)
    return words[:400]


@pytest.mark.parametrize("least, times", [(6, 4), (2, 4), (9, 5)])
def test_runs_like_the_plain_search(least, times):
    rng = random.Random(least)
    for _ in range(1200):
        words = repetitive(rng)
        assert runs_of(np.array(words), len(words), least, times) == plain_runs(words, least, times), words


def test_long_and_repetitive_in_bounded_time():
    rng = random.Random(8)
    began = time.process_time()
    n = 100_000
    assert runs_of(np.zeros(n, np.int64), n, 6, 4) == [(0, n, 1)]
    half = [0] * (n // 2) + [1] + [0] * (n // 2)
    assert runs_of(np.array(half), len(half), 6, 4) == [(0, n // 2, 1), (n // 2 + 1, n // 2, 1)]
    unit = [rng.randrange(1000) for _ in range(7001)]
    words = (unit * 15)[:n]
    assert (0, n, 7001) in runs_of(np.array(words), n, 6, 4)
    runs_of(np.array([rng.randrange(2) for _ in range(n)]), n, 6, 4)
    assert time.process_time() - began < 60


def test_odd_rows(spark):
    with_library(spark)
    rng = random.Random(2)
    docs = [(1, None), (2, ""), (3, " \t\x0b\n "), (None, "a " * 9), (4, "a b " * 4), (4, "a b " * 4), (4, "a b c a b c"), (5, "x y " * 6)]
    docs += [(10 + i, " ".join(map(str, repetitive(rng)))) for i in range(200)] + [(500, "la le li " * 30_000)]
    frame = spark.createDataFrame([(i, t, "z", 1) for i, t in docs], "doc_id long, text string, runs string, start int")
    rows = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(frame).collect()]
    assert (500, [(0, 90_000, 3)], "la le li") in rows
    expected = []
    for doc_id, text in docs:
        if doc_id != 500:
            words = (text or "").encode().split()
            runs = plain_runs(words)
            gone = {i for s, n, p in runs for i in range(s + p, s + n)}
            expected.append((doc_id, runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    assert sorted((r for r in rows if r[0] != 500), key=str) == sorted(expected, key=str)
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    expected = []
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = (text or "").encode().split()
        h, n = crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, original = g % n, list(words)
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = original[a + (i - a) % p]
        expected.append(plain_row(doc_id, words))
    assert sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SF).collect())) == sorted(expected)
