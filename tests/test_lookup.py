import pytest
from pyspark.sql import functions as F

from ridestrata.operators.stored import lookup_join, measured_bytes, scratch_folder, store


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows has one key, some have none."""
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(0, 40).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    return big, store(lookup, "test")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_broadcast_and_spread_agree(sides, how):
    big, lookup = sides
    small = lookup_join(big, lookup, ["k"], how)
    spread = lookup_join(big, lookup, ["k"], how, limit_bytes=0, spread=5)
    plain = big.join(lookup, "k", how)
    assert small.columns == spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert small.exceptAll(plain).isEmpty() and plain.exceptAll(small).isEmpty()


def test_two_keys_spread(spark):
    big = spark.range(500).select((F.col("id") % 7).alias("a"), F.col("id").alias("v"), (F.col("id") % 3).alias("b"))
    lookup = store(spark.range(7).select(F.col("id").alias("a"), F.lit(1).cast("bigint").alias("b"), F.lit("x").alias("c")), "two")
    plain = big.join(lookup, ["a", "b"], "left")
    spread = lookup_join(big, lookup, ["a", "b"], limit_bytes=0)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_size_is_measured(spark, sides):
    assert measured_bytes(sides[1]) > 40 * 16
    assert measured_bytes(sides[1].where("false")) == 0


def test_spread_plan_shuffles_and_small_plan_does_not(sides, capsys):
    big, lookup = sides
    lookup_join(big, lookup, ["k"]).explain()
    small = capsys.readouterr().out
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    lookup_join(big, lookup, ["k"], limit_bytes=0).explain()
    spread = capsys.readouterr().out
    assert "SortMergeJoin" in spread and "_slice" in spread and "Cartesian" not in spread


def test_scratch_is_the_folder_of_the_session(spark):
    assert scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_without_key_are_spread(spark):
    big = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    lookup = store(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("n")), "keys")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = lookup_join(big, lookup, ["k"], limit_bytes=0, spread=4)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 20_000 and len(sizes) == 64
        assert max(row["count"] for row in sizes) < 3 * 20_000 / 64
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
