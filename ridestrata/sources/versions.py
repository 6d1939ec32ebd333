"""Tables whose rows are replaced all at once.

A table ``layer.model`` is a view of its current version, an external Parquet table
``layer.model__v<number>_<id>``. A new version is written into a folder of its own; only
when all its files are there is the view pointed at it, in one statement of the catalog.
So a failed write leaves the old rows, a reader that has begun goes on with the files it
knows, and a model can be rebuilt from itself. A version may take over partitions of the
one before, by reference: their files are neither read nor written.

All versions of a table live under one folder, by version and then by partition:
``model.versions/_v=<version>/year=2024/month=1``. The version before the current one is
kept for its readers; files that neither refers to are deleted. One writer at a time.
"""

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

VERSION = "_v"
KEPT = 2  #: versions that stay, the current one among them
ADDED_TOGETHER = 500  #: partitions that one statement adds
NULL_VALUES = ("null", "__HIVE_DEFAULT_PARTITION__")

#: The partition columns and values of a folder, as text; None for NULL.
Spec = dict[str, str | None]


@dataclass(frozen=True)
class Staged:
    """A version that is written but not yet the current one."""

    spark: SparkSession
    layer: str
    model: str
    table: str
    columns: tuple[str, ...]

    def rows(self) -> DataFrame:
        return self.spark.table(self.table).select(*[f"`{name}`" for name in self.columns])


def _root(spark: SparkSession, layer: str, model: str) -> str:
    described = spark.sql(f"DESCRIBE DATABASE `{layer}`").collect()
    location = next(row[1] for row in described if row[0] == "Location")
    return f"{location.rstrip('/')}/{model}.versions"


def _versions(spark: SparkSession, layer: str, model: str) -> list[str]:
    """Version tables, oldest first."""
    found = spark.sql(f"SHOW TABLES IN `{layer}` LIKE '{model}__v*'").collect()
    names = [row["tableName"] for row in found]
    return sorted(name for name in names if re.fullmatch(rf"{re.escape(model)}__v\d{{9}}_[0-9a-f]{{8}}", name))


def current_version(spark: SparkSession, layer: str, model: str) -> str | None:
    """The version table that the view shows; None without the view."""
    if not spark.catalog.tableExists(f"{layer}.{model}"):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED `{layer}`.`{model}`").collect()
    text = next((row["data_type"] for row in described if row["col_name"] == "View Text"), "")
    found = re.search(rf"`({re.escape(model)}__v\d{{9}}_[0-9a-f]{{8}})`", text)
    return found[1] if found else None


def _spec(folder: str) -> Spec:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {name: None if value in NULL_VALUES else unquote(value) for name, value in pairs}


def _folders(spark: SparkSession, table: str) -> list[str]:
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _clause(folder: str) -> str:
    def literal(value: str | None) -> str:
        return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{name}` = {literal(value)}" for name, value in _spec(folder).items()) + ")"


def _create(spark: SparkSession, table: str, df: DataFrame, partitions: list[str], location: str) -> None:
    kinds = {field.name: field.dataType.simpleString() for field in df.schema} | {VERSION: "string"}
    names = [*[name for name in df.columns if name not in partitions], *partitions]
    columns = ", ".join(f"`{name}` {kinds[name]}" for name in names)
    by = f"PARTITIONED BY ({', '.join(f'`{name}`' for name in partitions)})"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{location}'")


def stage(
    df: DataFrame,
    layer: str,
    model: str,
    partition_by: tuple[str, ...] = (),
    stale: Callable[[list[Spec]], Callable[[Spec], bool]] | None = None,
) -> Staged:
    """Write a new version of ``layer.model`` without making it the current one.

    Without ``stale`` it holds the rows of ``df`` alone. With it, the current version's
    partitions come along, as they are, but those that are stale: ``stale`` gets the
    partitions that were written and gives the test. The table must have the same columns
    then."""
    spark = df.sparkSession
    versions = _versions(spark, layer, model)
    number = int(versions[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if versions else 1
    version = f"v{number:09d}_{uuid4().hex[:8]}"
    root, table = _root(spark, layer, model), f"`{layer}`.`{model}__{version}`"
    folder, parts = f"{root}/{VERSION}={version}", list(partition_by)
    writer = df.write.format("parquet")
    (writer.partitionBy(*parts) if parts else writer).save(folder)
    if parts:
        written = f"`{layer}`.`{model}__{version}_written`"
        _create(spark, written, df, parts, folder)
        spark.sql(f"MSCK REPAIR TABLE {written}")
        folders = [f"{VERSION}={version}/{found}" for found in _folders(spark, written)]
        spark.sql(f"DROP TABLE {written}")
    else:
        folders = [f"{VERSION}={version}"]
    before = current_version(spark, layer, model) if stale else None
    if before:
        gone = stale([_spec(found) for found in folders])
        folders += [found for found in _folders(spark, f"`{layer}`.`{before}`") if not gone(_spec(found))]
    _create(spark, table, df, [VERSION, *parts], root)
    for at in range(0, len(folders), ADDED_TOGETHER):
        clauses = " ".join(map(_clause, folders[at : at + ADDED_TOGETHER]))
        spark.sql(f"ALTER TABLE {table} ADD {clauses}")
    columns = [*[name for name in df.columns if name not in parts], *parts]
    return Staged(spark, layer, model, table, tuple(columns))


def publish(*staged: Staged) -> None:
    """Make staged versions the current ones, in the order given, then drop what neither
    the current version of a table nor the one before refers to."""
    for new in staged:
        name = f"`{new.layer}`.`{new.model}`"
        if new.spark.catalog.tableExists(f"{new.layer}.{new.model}") and not current_version(new.spark, new.layer, new.model):
            raise ValueError(f"{name} is not a table of versions")
        columns = ", ".join(f"`{column}`" for column in new.columns)
        new.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {new.table}")
    for new in staged:
        _retire(new.spark, new.layer, new.model)


def _retire(spark: SparkSession, layer: str, model: str) -> None:
    versions, current = _versions(spark, layer, model), current_version(spark, layer, model)
    older = versions[: versions.index(current)] if current in versions else []
    dropped = older[: max(0, len(older) - KEPT + 1)]
    if not dropped:
        return
    held = {folder for name in versions if name not in dropped for folder in _folders(spark, f"`{layer}`.`{name}`")}
    root = _root(spark, layer, model)
    for name in dropped:
        unused = [folder for folder in _folders(spark, f"`{layer}`.`{name}`") if folder not in held]
        spark.sql(f"DROP TABLE `{layer}`.`{name}`")
        _delete(spark, (f"{root}/{folder}" for folder in unused))


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
