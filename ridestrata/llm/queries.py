"""Registered queries of the text operators, over the whole driver tables."""

import os
from collections.abc import Callable
from pathlib import Path
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestrata.llm.bpe import coded, load_bpe
from ridestrata.llm.common import in_fold, table
from ridestrata.llm.decontaminate import leaks
from ridestrata.llm.importance import Sampling, resampled
from ridestrata.llm.language import identified, learn_languages
from ridestrata.llm.periodic import periodic_runs, run_lines, strongest
from ridestrata.llm.quality import learn_quality, scored
from ridestrata.llm.recompression import recompression_dedup
from ridestrata.llm.records import digests, token_records
from ridestrata.llm.rules import ruled
from ridestrata.llm.simhash import near_duplicates
from ridestrata.llm.suffix_dedup import suffix_dedup
from ridestrata.llm.toxicity import learn_toxicity, toxicity
from ridestrata.llm.urls import judged, rule_table
from ridestrata.operators.stored import lookup_join, scratch_path, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ROOT = str(Path(__file__).resolve().parents[2])


def with_library(spark: SparkSession) -> None:
    """Let local Python workers import this package; a cluster has it installed or
    gets it with ``--py-files``."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))


def query(function: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_library(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = prepared
    return prepared


@query
def op10_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, seed=42, distance=3)


@query
def op4_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup(table(spark, sf_dir, "documents"), width=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_recompression(spark, sf_dir):
    cut = recompression_dedup(table(spark, sf_dir, "documents"), width=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


@query
def op5_bpe(spark, sf_dir):
    bpe = load_bpe(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return coded(table(spark, sf_dir, "documents"), bpe)


#: The rules that the pages are judged by.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op7_url_rules(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


_RULE_VALUES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

ORACLE["op7_url_rules"] = f"""
WITH rules(h, p, v) AS (VALUES {_RULE_VALUES}),
rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rests
),
addresses AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM addresses JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""


def language_model(spark, sf_dir):
    """Learned from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return learn_languages(docs.where(~in_fold("doc_id", 5, 0)))


@query
def op1_language(spark, sf_dir):
    found = identified(table(spark, sf_dir, "documents"), language_model(spark, sf_dir))
    return found.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


def labelled(spark, sf_dir, label):
    """(doc_id, text) and the labels (doc_id, label) outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", label).where(~in_fold("doc_id", 4, 2))
    return table(spark, sf_dir, "documents").select("doc_id", "text"), labels


def _with_fold(scores, threshold):
    predicted = (F.col("score") >= threshold).cast("int")
    return scores.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", predicted.alias("predicted"))


@query
def op2_quality(spark, sf_dir):
    model = learn_quality(*labelled(spark, sf_dir, "quality"))
    return _with_fold(scored(table(spark, sf_dir, "documents"), model), 0.7)


@query
def op6_toxicity(spark, sf_dir):
    model = learn_toxicity(*labelled(spark, sf_dir, "toxic"))
    return _with_fold(toxicity(table(spark, sf_dir, "documents"), model), 0.3)


@query
def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    good = store(good.withColumn("trusted", F.lit(True)), "trusted")
    return ruled(lookup_join(docs.select("doc_id", "text"), good, ["doc_id"]))


@query
def op9_decontamination(spark, sf_dir):
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key").distinct()


@query
def op13_token_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return digests(token_records(docs, scratch_path(spark, "records"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


@query
def op11_importance(spark, sf_dir):
    settings = Sampling(buckets=10_000, longest=1, least_words=20, percent=10, seed=2024)
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), settings)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op11_importance"] = """
WITH texts AS (
  SELECT doc_id, 'd' AS side, text FROM documents UNION ALL SELECT NULL, 'b', text FROM benchmark
),
words AS (
  SELECT doc_id, side, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM texts
),
counted AS (SELECT doc_id, side, word, count(*) AS n FROM words GROUP BY ALL),
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS entries
  FROM range(256) AS t(i)
),
vocabulary AS (SELECT DISTINCT word FROM counted),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
      lambda p: ('0x' || substr(hex(encode(word)), 2 * p + 1, 2))::BIGINT)),
    lambda c, byte: xor(c >> 8, entries[(xor(c, byte) & 255) + 1]))) % 10000 AS bucket
  FROM vocabulary, crc_table
),
per_bucket AS (
  SELECT bucket, sum(CASE WHEN side = 'd' THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 'b' THEN n ELSE 0 END) AS t
  FROM counted JOIN hashed USING (word) GROUP BY bucket
),
totals AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM per_bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM per_bucket, totals
),
weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents AS d LEFT JOIN weights AS w ON d.doc_id = w.doc_id
),
places AS (
  SELECT *, CASE WHEN n_features >= 20 THEN
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM places
"""


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats, in about every tenth document by its id."""
    if doc_id is None or not words:
        return words
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    tail = words[at : at + period]
    return words[:at] + (tail * ((n - at) // period + 1))[: n - at]


@query
def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), least=6, times=4, words=planted)
    best = strongest(F.col("runs"))
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.encode(run_lines(F.col("runs")), "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
    )
