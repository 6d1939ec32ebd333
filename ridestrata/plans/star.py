"""Generic star-schema queries: a fact is counted by key before it meets a
dimension, so the join moves one row per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(fact: DataFrame, key: Column, name: str, count: str) -> DataFrame:
    return fact.groupBy(key.alias(name)).agg(F.count("*").alias(count))


def top_by_dimension(
    fact: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    labels: list[str],
    limit: int,
    count: str,
) -> DataFrame:
    """The ``limit`` dimension rows with the most fact rows; fact rows whose key
    the dimension lacks are not counted, ties go to the smaller key."""
    known = fact.where(F.col(key).isNotNull())
    return top_totals(counted(known, F.col(key), dim_key, count), dim, dim_key, labels, limit, count)


def top_totals(
    totals: DataFrame, dim: DataFrame, dim_key: str, labels: list[str], limit: int, count: str
) -> DataFrame:
    """The ``limit`` dimension rows with the greatest totals, one row per key."""
    return (
        totals.join(dim, dim_key)
        .select(dim_key, *labels, count)
        .orderBy(F.desc(count), dim_key)
        .limit(limit)
    )


def with_context(totals: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Totals per key with the dimension's columns, NULL where it has no row."""
    return totals.join(dim, key, "left")
