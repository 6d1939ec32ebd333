"""BPE, URL rules, quality rules, decontamination and the models."""

import math
import random
import re
import time
from collections import Counter
from functools import partial
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridestrata.llm import decontaminate, language, quality, stretches, toxicity
from ridestrata.llm.bpe import coded, load_bpe, token_ids
from ridestrata.llm.common import bounded_sample
from ridestrata.llm.decontaminate import covered, leaks, tiles, tokens, without_leaks
from ridestrata.llm.queries import ORACLE, QUERIES, URL_RULES
from ridestrata.llm.rules import _hashes, _repeat_words, ruled
from ridestrata.llm.urls import judged, rule_table
from tests.compare import difference, duckdb_over
from tests.llm.brute import plain_leaks, plain_tiles

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def bpe():
    return load_bpe(None, public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.no_padding()
    found.no_truncation()
    return found


def test_bpe_like_the_library(bpe, library):
    rng = random.Random(1)
    parts = [*"ab Zé\n\t\r  '’.,!?019½²中😀\x85\x1c\xa0\u3000", "'s", "'LL", "<|endoftext|>", " the", "  ", "\n\n"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)
    long = "abcdefghij" * 5000
    assert bpe.encode(long) == library.encode(long, add_special_tokens=False).ids


def test_coded_rows(spark, bpe, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (None, "<|endoftext|>x")]
    frame = spark.createDataFrame([(i, t, "y") for i, t in rows], f"{DOCS}, n_tokens string")
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, coded(frame, bpe).collect()), key=str) == sorted(expected, key=str)
    assert {r["doc_id"]: r["ids"] for r in token_ids(frame.where("doc_id = 1"), bpe).collect()}[1] == bpe.encode("Hello  world")
    assert coded(spark.createDataFrame([], DOCS), bpe).count() == 0


def test_a_worker_remembers_a_word_once_and_few_of_them(bpe, monkeypatch):
    monkeypatch.setattr(stretches, "STRETCHES", 80)
    bpe.begin(bpe.added)
    words = ["".join(chr(97 + n // 26**k % 26) for k in range(3)) for n in range(300)]
    texts = pa.array(["x " + " ".join(words[at : at + 30]) for at in range(0, 300, 30)])
    for at in range(len(texts)):
        sizes, joined, decoded = bpe.coded(texts.slice(at, 1))
        assert joined[0].as_py() == bpe.encode_joined(texts[at].as_py())
        assert len(bpe._words) <= 40 and len(bpe._older_words) <= 40
    bpe.begin(bpe.added)
    bpe.coded(texts.slice(0, 1))
    assert {word for word in bpe._words if word.isalpha()} and not any(piece[0] == " " for piece in bpe._known)
    bpe.begin(bpe.added)


def test_a_piece_is_merged_once(bpe, monkeypatch):
    """Marks behind a word, and a text's beginning, do not make it another piece."""
    merged, merge = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda piece: merged.append(piece) or merge(piece))
    bpe.begin(bpe.added)
    texts = ["so ñuvéqa ñuvéqa, ñuvéqa. (ñuvéqa", "a ñuvéqa&&& ñuvéqa?! <|endoftext|> ñuvéqa"] * 3
    sizes, joined, decoded = bpe.coded(pa.array(texts))
    assert merged.count(" ñuvéqa".encode()) == 1
    for text, size, ids, back in zip(texts, sizes, joined.to_pylist(), decoded.to_pylist()):
        assert [int(i) for i in ids.split(",")] == bpe.encode(text) and len(bpe.encode(text)) == size and back.decode() == text


URLS = [
    "http://A.Example.ORG/en/12?x", "https://example.org/es/", "ftp://org/", "http://org", "x://example.org?/es/",
    None, "", "no scheme", "a://b://c.com/de/1", "http://notexample.org/es/", "http://x.com/fr/#a", "http://com/de/", "http://é.org/ü",
]


def url_row(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_rules(spark):
    rows = [(i, u, "z") for i, u in enumerate(URLS)] + [(0, URLS[0], "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = judged(pages, rule_table(spark, URL_RULES)).collect()
    assert sorted(map(tuple, found)) == sorted((i, *url_row(u)) for i, u, _ in rows)
    none = judged(pages, rule_table(spark, URL_RULES).where("false"), "block")
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "block")}
    assert judged(pages.where("false"), rule_table(spark, URL_RULES)).count() == 0


def test_url_query(spark):
    assert difference(QUERIES["op7_url_rules"](spark, SF), duckdb_over(SF), ORACLE["op7_url_rules"]) is None


def base_row(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, doubled = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered_words = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(5)}
    n = len(covered_words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, doubled, n, len(words) < 10 or 100 * n > 20 * len(words)


def test_repeated_windows_like_a_plain_count(spark):
    rng = random.Random(7)
    lists = [[rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(n)] for n in range(0, 60) for _ in range(3)]
    lists += [[*map(str, range(40)), *map(str, range(5, 20)), "x", *map(str, range(5, 10))]]
    expected = {}
    for i, words in enumerate(lists):
        windows = [tuple(words[at : at + 5]) for at in range(len(words) - 4)]
        expected[i] = len({at + k for at, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})
    frame = spark.createDataFrame(list(enumerate(lists)), "i int, w array<string>").withColumn("h", _hashes(F.col("w")))
    found = frame.select("i", _repeat_words(F.col("w"), F.col("h"), 5).alias("n"))
    assert {r["i"]: r["n"] for r in found.collect()} == expected
    # Sorted by their natural order, not by a function that is called for each comparison.
    assert "array_sort(" not in found._jdf.queryExecution().analyzed().toString()


def test_base_rules_and_verdict(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "bé", "#c", "d|", "\n", "e\te", "f"], k=rng.randrange(80))) for _ in range(60)]
    texts += [None, "", "   ", "a b c d e " * 3000, "x", "one two\none two\n \n \none two", "a b c d e a b c d e", "\u00a0 a\u2028b"]
    rows = [(i, t, i % 3 == 0, 1) for i, t in enumerate(texts)] + [(0, texts[0], True, 1)]
    frame = spark.createDataFrame(rows, f"{DOCS}, trusted boolean, n_words int")
    found = ruled(frame).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((r["doc_id"], *(r[n] for n in names)) for r in found) == sorted((i, *base_row(t)) for i, t, _, _ in rows)
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= -0.25) for r in found)
    assert ruled(frame.where("false")).count() == 0


def test_score_is_the_mean_ratio(spark):
    good, bad = "fine words here and there " * 4, "$$$ %%% ### &&& *** " * 4
    rows = [(i, good + str(i), True) for i in range(30)] + [(99, bad + "u v w x y z", False)]
    found = {r["doc_id"]: r["score"] for r in ruled(spark.createDataFrame(rows, f"{DOCS}, trusted boolean")).collect()}
    assert found[99] < -0.25 < min(score for i, score in found.items() if i != 99)


def plain_scores(rows, buckets):
    """Scores by plain counting: XXH64 of words and, chained, of pairs and the text's end."""

    def chained(*numbers):
        seed = 42
        for number in numbers:
            seed = xxhash.xxh64_intdigest(number.to_bytes(8, "little"), seed)
        return (seed - (seed >> 63 << 64)) % buckets

    def places(text):
        named = [xxhash.xxh64_intdigest(word.encode(), 42) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return [chained(h) for h in named] + [chained(*named[i : i + 2]) for i in range(len(named))]

    trusted, every = Counter(), Counter()
    for _, text, good in rows:
        every.update(places(text))
        trusted.update(places(text) if good else [])
    share = lambda counts, place: (counts[place] + 0.5) / (counts.total() + 0.5 * buckets)
    ratio = lambda place: math.log(share(trusted, place) / share(every, place))
    return [(i, sum(map(ratio, places(text))) / max(len(places(text)), 1)) for i, text, _ in rows]


@pytest.mark.parametrize("buckets", [64, 1 << 18])
def test_scores_equal_a_plain_count(spark, buckets):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["a", "bé", "#c", "d|", "\n", "e\te", "fine", "words"], k=rng.randrange(40))) for _ in range(50)]
    texts += [None, "", "one", "tie tie", "tie tie", "very long " * 5000]
    rows = [(i, text, [True, False, None][i % 3]) for i, text in enumerate(texts)]
    found = ruled(spark.createDataFrame(rows, f"{DOCS}, trusted boolean"), buckets=buckets).collect()
    assert sorted((r["doc_id"], r["score"]) for r in found) == [(i, pytest.approx(s, abs=1e-9)) for i, s in plain_scores(rows, buckets)]


def test_order_of_words_counts(spark):
    """Shuffled words of a trusted text score below it, and a score at the threshold is kept."""
    rng = random.Random(2)
    good = [f"the {a} of {b} is {c} for {a}" for a in "xyz" for b in "uvw" for c in "rst"]
    shuffled = [" ".join(rng.sample(text.split() * 2, 16)) for text in good]
    rows = [(i, text + " " + text, True) for i, text in enumerate(good)]
    rows += [(100 + i, text, False) for i, text in enumerate(shuffled)]
    frame = spark.createDataFrame(rows, f"{DOCS}, trusted boolean")
    rows = ruled(frame).collect()
    found = {r["doc_id"]: r["score"] for r in rows}
    assert max(found[i] for i in found if i >= 100) < min(found[i] for i in found if i < 100)
    scores = sorted(r["score"] for r in rows if not r["base_failed"])
    tie = scores[len(scores) // 2]
    at = {r["doc_id"]: r for r in ruled(frame, threshold=tie).collect()}
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= tie) for r in at.values())
    assert any(r["score"] == tie and r["kept"] for r in at.values() if not r["base_failed"])


def test_tiles_do_not_overlap_and_find_reordered_parts():
    rng = random.Random(5)
    for _ in range(200):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 30))]
        text = [rng.randrange(0, 6) for _ in range(rng.randrange(60))]
        found = tiles(item, text, 3)
        assert all(k >= 3 and item[p : p + k] == text[t : t + k] for p, t, k in found)
        assert len({p + i for p, _, k in found for i in range(k)}) == sum(k for *_, k in found)
        assert len({t + i for _, t, k in found for i in range(k)}) == sum(k for *_, k in found)
    words = [f"w{i}" for i in range(30)]
    assert covered(words, words[20:] + ["x"] + words[:10] + ["y"] + words[10:20], 5) == (30, 3)


def test_tiles_like_the_plain_greedy_search():
    rng = random.Random(6)
    for number in range(500):
        letters = rng.choice([1, 2, 3, 6])
        item = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 45))]
        text = [rng.randrange(0, letters + 1) for _ in range(rng.randrange(70))]
        if number % 3 == 0:
            text = text[:9] + item[3:40] + text[:2] + item[: rng.randrange(40)] + text
        match = rng.choice([1, 2, 3, 5])
        assert tiles(item, text, match) == plain_tiles(item, text, match), (item, text, match)


def test_repetitive_texts_are_tiled_in_bounded_time():
    began = time.process_time()
    assert covered(["la"] * 200, ["la"] * 8000, 5) == (200, 1)
    assert covered(["la", "li"] * 100, ["x"] + ["la", "li"] * 4000, 5) == (200, 1)
    assert covered(["a"] * 100 + ["b"] * 100, (["a"] * 60 + ["b"] * 60 + ["c"]) * 60, 5)[0] == 200
    assert time.process_time() - began < 3


@pytest.mark.parametrize("most_bits, limit", [(28, 1 << 26), (8, 0)])
def test_leaks_like_the_plain_search(spark, monkeypatch, most_bits, limit):
    """Also with seeds too many for a broadcast, which are spread, and for the bitmap."""
    monkeypatch.setattr(decontaminate, "MOST_BITS", most_bits)
    monkeypatch.setattr(decontaminate, "lookup_join", partial(decontaminate.lookup_join, limit_bytes=limit))
    rng = random.Random(12)
    items = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(1, 30)))) for i in range(25)]
    items += [(100, "la " * 12), (101, "One two three four five six"), (102, "one two")]
    docs = []
    for i in range(150):
        part = rng.choice(items)[1].split()
        cut = rng.randrange(len(part))
        docs.append((i, " ".join(rng.choices("abcdefxyz", k=rng.randrange(20)) + part[cut:] + ["x"] + part[:cut] + rng.choices("abc", k=9))))
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    rows = {(r["doc_id"], r["item_id"], r["n_tokens"], r["n_covered"], r["n_tiles"]) for r in found}
    assert rows == plain_leaks(docs, items, 5, 0.6, tokens) and len(found) == len(rows)


def test_bitmap_grows_with_the_seeds_and_knows_all(spark):
    rng = np.random.default_rng(3)
    others = rng.integers(0, 1 << 64, 1_000_000, dtype=np.uint64)
    for n, expected in ((0, 25), (1, 25), (700, 25), (150_000, 26)):
        names = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        seeds = spark.createDataFrame(pa.table({"seed": pa.array(names.view(np.int64))}))
        bits, width = decontaminate._bitmap(seeds)
        assert width == expected and len(bits) == 1 << (width - 6)
        assert decontaminate._known(names, bits, width).all()
        assert decontaminate._known(others, bits, width).mean() < 1 / 16_000
        assert sum(int(word).bit_count() for word in bits[bits > 0]) == len(set(np.concatenate(decontaminate._probes(names, width)).tolist()))


def test_leaks(spark):
    item = " ".join(f"Word{i}" for i in range(24))
    half, other = item.split()[:12], [f"z{i}" for i in range(50)]
    docs = [
        (1, "start " + item.upper() + " end"), (2, " ".join(item.split()[12:] + other + half)), (3, " ".join(half + other)),
        (4, None), (5, ""), (6, " ".join(other)), (None, item), (1, "start " + item.upper() + " end"), (7, "say tiny item, so"),
    ]
    items = spark.createDataFrame([(10, item, 0), (10, item, 0), (11, None, 0), (12, "", 0), (13, "tiny item", 0)], "item_id long, text string, n int")
    frame = spark.createDataFrame([(i, t, "s") for i, t in docs], f"{DOCS}, seeds string")
    found = {(r["doc_id"], r["item_id"], r["n_covered"], r["n_tiles"]) for r in leaks(frame, items).collect()}
    assert found == {(1, 10, 24, 1), (2, 10, 24, 2), (None, 10, 24, 1), (7, 13, 2, 1)}
    kept = without_leaks(frame, items)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
    assert leaks(frame.where("false"), items).count() == 0 and leaks(frame, items.where("false")).count() == 0


def test_leaks_of_items_that_repeat_runs(spark):
    one, refrain = " ".join(["la"] * 10), "we all sing this song"
    verses = [" ".join(f"{v}{i}" for i in range(5)) for v in "abcd"]
    song = " ".join(f"{refrain} {verse}" for verse in verses)
    table = " ".join("0 1" for _ in range(12))
    items = [(1, one), (2, song), (3, table)]
    docs = [
        (1, f"x {one} y"), (2, f"{refrain} x {refrain} y {refrain} z {refrain} u {verses[2]}"), (3, f"n {table} 2"),
        (4, "la la la la la"), (5, refrain), (6, "0 1 0 1 0 1"), (1, f"x {one} y"),
    ]
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    rows = [(r["doc_id"], r["item_id"], r["n_tokens"], r["n_covered"]) for r in found.collect()]
    assert sorted(rows) == [(1, 1, 10, 10), (2, 2, 40, 25), (3, 3, 24, 24)]


def test_leaks_find_every_whole_item(spark):
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontamination"](spark, SF).collect()}
    plain = lambda text: f" {' '.join(tokens(text))} "
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    whole = {(d["doc_id"], i["item_id"]) for d in docs for i in items if plain(i["text"]) in plain(d["text"])}
    assert whole and whole <= found


ODD = [(1, "one text of words"), (1, "one text of words"), (2, None), (3, ""), (4, "123 !!"), (None, "x " * 30_000)]


def odd_frame(spark):
    return spark.createDataFrame([(i, t, 0.5, "q") for i, t in ODD], f"{DOCS}, score double, lang_pred string")


def test_language_rows(spark):
    texts = ["the cat and the dog are here", "der Hund und die Katze sind hier"] * 20
    model = language.train(texts, ["en", "de"] * 20)
    found = language.identified(odd_frame(spark), model).collect()
    assert len(found) == len(ODD)
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (2, 3, 4)) and 0 <= r["score"] <= 1 for r in found)
    assert all(r["rejected"] for r in found if r["lang_pred"] == "und")
    assert language.identified(odd_frame(spark).where("false"), model).count() == 0
    untaught = language.learn_languages(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language.identified(odd_frame(spark), untaught).collect()} == {"und"}


def test_sample_takes_every_label(spark):
    rows = [(i, f"text {i}", f"l{i:03}") for i in range(260)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert [r["lang"] for r in bounded_sample(frame, "lang", 2, 100)] == [lang for *_, lang in rows]


def test_sample_takes_the_first_by_hash(spark):
    rows = [(i, f"text {i}", "often" if i % 50 else "seldom") for i in range(2000)]
    rows += [(7, "text 7", "often")] * 30 + [(5000, "x" * 101, "seldom"), (5001, "none", None), (5002, None, "seldom")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("also", F.lit(1))
    hashed = frame.where("lang is not null and length(text) <= 100").withColumn("h", F.xxhash64("doc_id", "text", F.lit(11)))
    for most in (10, 60, 5000):
        found = bounded_sample(frame, "lang", most, 100)
        for lang in ("often", "seldom"):
            plain = sorted((r["h"], r["doc_id"]) for r in hashed.where(F.col("lang") == lang).collect())[:most]
            assert [r["doc_id"] for r in found if r["lang"] == lang] == [doc_id for _, doc_id in plain]
        assert set(found[0]) == set(frame.columns)
    with pytest.raises(ValueError, match="values of lang"):
        bounded_sample(frame, "lang", 10, 100, most_labels=1)
    with pytest.raises(ValueError, match="characters"):
        bounded_sample(frame, "lang", 10, 100, most_chars=50)


def test_sample_with_labels_of_another_table(spark):
    rows = [(i, f"text {i}") for i in range(900)] + [(None, "no id"), (3, None), (7, "text 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("also", F.lit(1))
    labels = spark.createDataFrame([(i, i % 3) for i in range(0, 900, 2)] + [(None, 1), (5000, 1), (4, None)], "doc_id long, toxic int")
    for most in (10, 70, 500):
        joined = bounded_sample(docs.join(labels, "doc_id"), "toxic", most, 100)
        assert bounded_sample(docs, "toxic", most, 100, labels) == [{n: r[n] for n in ("doc_id", "text", "also", "toxic")} for r in joined]
    assert bounded_sample(docs, "toxic", 10, 100, labels.where("false")) == []


def test_sample_takes_no_more_jobs_for_more_labels(spark, monkeypatch):
    calls = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: calls.append(1) or collect(self))
    for labels in (2, 9):
        frame = spark.createDataFrame([(i, f"text {i}", f"l{i % labels}") for i in range(900)], "doc_id long, text string, lang string")
        assert len(bounded_sample(frame, "lang", 20, 100)) == 20 * labels
    assert calls[: len(calls) // 2] == calls[len(calls) // 2 :]


def test_quality_and_toxicity_rows(spark):
    good, bad = "fine words here and there ", "you idiot you stupid MORON!! "
    labels = np.array([0.0, 1.0] * 40)
    texts = [good * (1 + i % 5) if not y else good + bad * (1 + i % 3) for i, y in enumerate(labels)]
    nice = quality.train(quality.features(texts), 1 - labels)
    rude = toxicity.train(texts, labels)
    for found in (quality.scored(odd_frame(spark), nice), toxicity.toxicity(odd_frame(spark), rude)):
        rows = found.collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert found.where("false").count() == 0
    assert rude.scores([good + bad])[0] > 0.7 > 0.3 > rude.scores([good])[0]
    assert rude.scores(["you 1d!ot " * 3])[0] >= 0
    empty = spark.createDataFrame([], "doc_id long, text string, quality int, toxic int")
    assert quality.learn_quality(empty).scores(quality.features(["a"]))[0] == 0.5
    assert toxicity.learn_toxicity(empty).scores(["a"])[0] == 0


def test_isotonic_never_falls():
    for seed in range(200):
        rng = np.random.default_rng(seed)
        sums = rng.normal(size=400).round(seed % 3)
        starts, values = toxicity.isotonic(sums, (rng.random(400) < 1 / (1 + np.exp(-sums))).astype(float))
        assert (np.diff(starts) > 0).all() and (np.diff(values) >= 0).all()


@pytest.mark.parametrize("name,label,cut,least", [("op2_quality", "quality", 0.7, 0.9), ("op6_toxicity", "toxic", 0.3, 0.85)])
def test_held_out_accuracy(spark, name, label, cut, least):
    sf = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r["predicted"] == int(r["score"] >= cut) for r in found)
    assert sum(r["predicted"] == r[label] for r in found) / len(found) >= least


def test_held_out_language(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language"](spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) >= 0.98
