"""Fingerprints, links and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from ridestrata.llm.simhash import fingerprint, fingerprint_links, first_of_each, near_duplicates, segment_counts
from ridestrata.llm.simhash import _manhattan
from ridestrata.llm.graph import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(gram.encode(), seed=42).intdigest() for gram in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(points, distance):
    """The least member of each one's group, over all pairs."""
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if bin(a ^ b).count("1") <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in points}


@pytest.mark.parametrize("text", ["", " \n", "One", "ÀB cD", "a b c d e f A B C", "x " * 500, None, "é\x85ü \x1c z"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_counts_bound_the_distance():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**64, 2000, dtype=np.uint64) for _ in range(2))
    bound = _manhattan(segment_counts(a), segment_counts(b))
    apart = [
        sum(abs(bin(x >> i & 3).count("1") - bin(y >> i & 3).count("1")) for i in range(0, 64, 2))
        for x, y in zip(a.tolist(), b.tolist())
    ]
    assert bound.tolist() == apart
    assert (bound <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("limit", [1024, 20, 2])
def test_links_join_what_is_near(spark, limit):
    rng = random.Random(limit)
    points = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            centre ^= sum(1 << rng.randrange(64) for _ in range(rng.randrange(3)))
            points.add(centre % 2**64)
    points |= {0, 1, 7, 2**63, 2**64 - 1}
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in points]
    found = fingerprint_links(spark.createDataFrame(signed, "fp long").repartition(4), 3, limit)
    root = {r["node"]: r["root"] for r in components(found).collect()}
    value = {p: root.get(p, p) for (p,) in signed}
    expected = roots(sorted(points), 3)
    groups, wanted = {}, {}
    for p in points:
        groups.setdefault(value[int(np.uint64(p).astype(np.int64))], set()).add(p)
        wanted.setdefault(expected[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_odd_rows(spark):
    rows = [(5, "a b c d"), (3, "A b C d"), (9, None), (8, ""), (9, None), (None, " "), (None, "lone words here only"), (2, "other " * 40)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    found = sorted((tuple(r) for r in near_duplicates(frame).collect()), key=str)
    least = {"a b c d": 3, "A b C d": 3, None: 8, "": 8, " ": 8, "lone words here only": None, "other " * 40: 2}
    assert found == sorted(((i, f"{plain_fingerprint(t):016x}", least[t]) for i, t in rows), key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in first_of_each(frame).collect()), key=str)
    assert kept == sorted([(3, "A b C d"), (8, ""), (None, "lone words here only"), (2, "other " * 40)], key=str)
    assert first_of_each(frame).columns == frame.columns


def test_repeated_ids_stay_once_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (4, "a b c")], "doc_id long, text string")
    assert [tuple(r) for r in first_of_each(frame).collect()] == [(1, "a b c")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and first_of_each(empty).count() == 0


def test_each_group_keeps_its_lead_under_a_shared_id(spark):
    one, two, three = "a b c d", "other " * 40, "lone words here only"
    rows = [(1, one), (1, two), (1, two), (5, one), (6, two), (3, three), (3, one), (7, three), (8, None), (None, three)]
    frame = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id int")
    kept = sorted(((r["doc_id"], r["text"]) for r in first_of_each(frame).collect()), key=str)
    assert kept == sorted([(1, one), (1, two), (3, three), (8, None)], key=str)
