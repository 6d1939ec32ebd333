"""Small intermediate tables: written once, measured, then joined by size.

Lookup sets such as drifting station ids are cheap to hold but expensive to
recompute, and their size is known only after they are built. ``store`` writes
one to the shared scratch folder, and ``lookup_join`` broadcasts it only when
its measured size is under a bound; a larger one is joined by key with the hot
keys of the big side spread over several tasks.
"""

import tempfile
from functools import reduce
from operator import add, and_, or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD = 32
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="ridestrata-"))
    return _local_scratch[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_folder(spark)}/{app}/{label}-{uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage,
    survives lost executors, and gives the planner its real size. The shuffle files
    of the write are of no more use and go with it, without waiting for the driver's
    garbage collection."""
    path = scratch_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Size of a stored table in memory, from its row count and its widths."""

    def width(column: Column, kind: T.DataType):
        if isinstance(kind, T.StructType):
            return reduce(add, (width(column[field.name], field.dataType) for field in kind), F.lit(16))
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType):
            return F.coalesce(F.size(column), F.lit(0)) * 48 + 24
        return F.lit(16)

    row = reduce(add, (width(F.col(field.name), field.dataType) for field in df.schema))
    total = df.agg(F.sum(row.cast("bigint")).alias("bytes")).first()["bytes"]
    return total or 0


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    size: int | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    spread: int = SPREAD,
) -> DataFrame:
    """Join a big table to a stored lookup table that has one row per key.

    ``how`` is a join type that keeps or drops rows of ``big`` (left, inner,
    left_semi, left_anti); ``size`` is the lookup's measured size if it is known
    already. An empty lookup needs no anti-join. Under ``limit_bytes`` the lookup is broadcast and the
    big side does not move. Beyond it both sides are shuffled: every lookup row
    is repeated once per slice and each big row takes one slice, so a key that
    holds a large part of the rows is shared by ``spread`` tasks. The slice comes
    from the row's values, so a task that is run again sends its rows to the same
    places; copies of one row that still gather are left to adaptive execution,
    which splits large partitions of such a join. Rows with a NULL key match nothing
    and are spread over all tasks.
    """
    if size is None:
        size = measured_bytes(lookup)
    if size == 0 and how == "left_anti":
        return big
    if size <= limit_bytes:
        return big.join(F.broadcast(lookup), on, how)
    every_slice = F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))
    slices = F.explode(every_slice).alias("_slice")
    repeated = lookup.select("*", slices).alias("r")
    row, no_key = F.xxhash64(*big.columns), reduce(or_, (F.col(name).isNull() for name in on))
    own_slice = F.when(no_key, row).otherwise(F.pmod(row, F.lit(spread)))
    sliced = big.withColumn("_slice", own_slice).alias("l")
    same = reduce(and_, (F.col(f"l.{name}") == F.col(f"r.{name}") for name in [*on, "_slice"]))
    joined = sliced.join(repeated.hint("merge"), same, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_slice")
    found = [name for name in lookup.columns if name not in on]
    kept = [F.col(f"l.{name}") for name in big.columns]
    keys_first = [F.col(f"l.{name}") for name in on] + [
        column for name, column in zip(big.columns, kept) if name not in on
    ]
    return joined.select(*keys_first, *[F.col(f"r.{name}") for name in found])
