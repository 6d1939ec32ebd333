"""The corpus pipeline: languages, near copies, repeated strings, leaked test items,
tokens. Every stage works on all rows its predecessor kept."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestrata.llm.bpe import coded, load_bpe
from ridestrata.llm.common import table
from ridestrata.llm.decontaminate import without_leaks
from ridestrata.llm.language import language_of
from ridestrata.llm.queries import language_model, with_library
from ridestrata.llm.simhash import first_of_each
from ridestrata.llm.suffix_dedup import with_kept_text
from ridestrata.operators.stored import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty. Null texts and those without
    a letter go; of equally likely languages the first by name is told."""
    with_library(spark)
    found = language_of(F.col("text"), language_model(spark, sf_dir))
    return docs.where(~found["rejected"])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; one of repeated rows.
    Null and empty texts are one group."""
    with_library(spark)
    return first_of_each(docs, shingle=3, distance=3)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that one with a smaller id holds. One of
    which nothing is left stays, with an empty text. Null texts stay null; repeated rows
    have the same result each; rows without an id stay whole."""
    with_library(spark)
    return with_kept_text(docs, width=50)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts stay; repeated
    rows stay or go together."""
    with_library(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and digest of each document's tokens, and of their decoded text. Null
    texts count as empty; repeated rows come back repeated."""
    with_library(spark)
    return coded(docs, load_bpe(spark, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language identification", known_language),
    ("SimHash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeated_strings),
    ("benchmark decontamination", without_test_items),
    ("BPE encoding and decoding", tokenized),
]

#: Trained models, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. Other columns than those
    that a stage names pass through all but the last; names that begin with ``_rs_`` are
    reserved. An empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
