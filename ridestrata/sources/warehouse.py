"""Layered warehouse tables: names, sinks, scans and SQL."""

import re
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ridestrata.sources.versions import Spec, publish, stage

LAYERS = ("bronze", "silver", "gold", "audit")


def create_layers(
    spark: SparkSession, layers: tuple[str, ...] = LAYERS, location: str | None = None
) -> None:
    """One database per layer, in the warehouse or in folders of ``location``."""
    for layer in layers:
        folder = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{folder}")


def table_name(layer: str | None, model: str) -> str:
    """The layer's name as given, trimmed, without a prefix."""
    if layer is None or not layer.strip():
        raise ValueError(f"model {model!r} has no layer")
    return f"{layer.strip()}.{model}"


def read_model(spark: SparkSession, layer: str, model: str) -> DataFrame:
    return spark.table(table_name(layer, model))


def replace_table(
    df: DataFrame, layer: str, model: str, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Rebuild a table from scratch and return its scan. Its rows change all at once when
    the new ones are written; ``df`` may read the table itself."""
    name = table_name(layer, model)
    publish(stage(df, layer.strip(), model, partition_by))
    return df.sparkSession.table(name)


def replace_months(
    df: DataFrame,
    layer: str,
    model: str,
    partition_by: tuple[str, ...] = ("year", "month"),
    months: Iterable[tuple[int, int]] | None = None,
) -> DataFrame:
    """Replace only the given months, or those that the rows belong to, so a month can be
    loaded again without touching the others. Months that are given and have no rows any
    more are gone afterwards."""
    name = table_name(layer, model)
    publish(stage(df, layer.strip(), model, partition_by, of_months(months)))
    return df.sparkSession.table(name)


def of_months(months: Iterable[tuple[int, int]] | None) -> Callable[[list[Spec]], Callable[[Spec], bool]]:
    """Stored partitions of these months, or of the months that are written, are stale."""
    named = None if months is None else {(str(year), str(month)) for year, month in months}

    def stale(written: list[Spec]) -> Callable[[Spec], bool]:
        wanted = {(spec["year"], spec["month"]) for spec in written} if named is None else named
        return lambda spec: (spec["year"], spec["month"]) in wanted

    return stale


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """The same for a table that is only a folder."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def create_table(df: DataFrame, layer: str, model: str) -> DataFrame:
    """Write a table that must not exist yet."""
    name = table_name(layer, model)
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def create_folder(df: DataFrame, path: str) -> DataFrame:
    """The same for a table that is only a folder."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **binds) -> DataFrame:
    """One statement with named parameters (``:name``); None binds NULL."""
    return spark.sql(text, args=binds)


def run_sql_file(spark: SparkSession, path: str, **binds) -> DataFrame | None:
    """All statements of a file, each ended by a semicolon at the end of a line;
    returns the last result."""
    result = None
    for statement in re.split(r";[ \t]*\r?\n", Path(path).read_text() + "\n"):
        if statement.strip():
            result = run_sql(spark, statement, **binds)
    return result


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lowest: str,
    highest: str,
    partitions: int,
    **options,
) -> DataFrame:
    """A table of an external database, read by ranges of a column in parallel."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column)
        .options(lowerBound=lowest, upperBound=highest, numPartitions=partitions)
        .options(**options)
        .load()
    )
