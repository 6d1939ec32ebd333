"""The pipeline against plain versions of its stages."""

import corpus_pipeline
from ridestrata.llm.queries import QUERIES
from tests.llm.brute import substring_rows, window_rows
from tests.llm.test_repeats import digests

SF = "/root/testdata/sf0.001"


def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_dedup_queries(spark):
    docs = texts(spark)
    four = sorted(map(tuple, QUERIES["op4_suffix_dedup"](spark, SF).collect()), key=str)
    assert four == substring_rows(docs, 50)
    assert sorted(map(tuple, QUERIES["op8_recompression"](spark, SF).collect()), key=str) == window_rows(docs, 20)


def test_stages_take_effect(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = corpus_pipeline.known_language(spark, docs, SF).cache()
    assert told.columns == columns and told.count() >= docs.count() * 0.98
    groups = {r["doc_id"]: r["component_id"] for r in QUERIES["op10_simhash"](spark, SF).collect()}
    single = corpus_pipeline.one_of_near_copies(spark, docs, SF)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(groups.values()))
    cut = corpus_pipeline.without_repeated_strings(spark, docs, SF)
    removed = {row[0]: row[2] for row in substring_rows(texts(spark), 50)}
    for row in cut.collect():
        assert row["n_chars"] == len(row["text"])
        assert removed[row["doc_id"]] > 0 or (row["doc_id"], row["text"]) in set(texts(spark))
    leaked = {r["doc_id"] for r in QUERIES["op9_decontamination"](spark, SF).collect()}
    clean = corpus_pipeline.without_test_items(spark, docs, SF)
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == set(groups) - leaked


def test_run_and_odd_documents(spark, tmp_path):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and result.count() > 100
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(1, None, None, None, None, 1.0), (None, "the words", "en", "a", 9, 1.0), (2, "", "en", "a", 0, 1.0), (3, "and the words of this", "en", "a", 21, 1.0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count(), name
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
