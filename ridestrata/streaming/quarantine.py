"""Quarantine of a stream of landed files.

Rules that read one row are judged as the row is appended. Whether an identifier drifts
depends on rows of all batches, so the distinct names of every identifier are the state of
a second stream, which is kept across batches and calls. Rows meet the identifiers that
drift so far when they are read, so a name that arrives late also puts the rows loaded
before it into quarantine, and no row is written twice."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.operators.quarantine import flag
from ridestrata.operators.rules import (
    TRIP_DRIFT,
    Drift,
    Rule,
    any_failing,
    failing_names,
    of_several_names,
    roles_of,
    with_drift,
)
from ridestrata.operators.stored import store
from ridestrata.schemas import TRIPS
from ridestrata.streaming.replay import append_new, landed_files

SPREAD = 32
CHECKED = T.StructType(
    [
        *TRIPS.fields,
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("is_bad", T.BooleanType()),
        T.StructField("failed_rules", T.ArrayType(T.StringType())),
    ]
)


def append_checked(
    spark: SparkSession, root: str, folder: str, rules: list[Rule] | None = None, files_per_batch: int = 100
) -> None:
    """Append the trips of new files, judged by the rules that read one row."""
    checked = flag(landed_files(spark, root, files_per_batch), rules, drift=())
    append_new(checked, f"{folder}/checked", f"{folder}/progress/checked", ("year", "month")).awaitTermination()


def append_names(
    spark: SparkSession, folder: str, drift: tuple[Drift, ...] = TRIP_DRIFT, across_roles: bool = False
) -> None:
    """Append the (role, id, name) that no checked row had before.

    A stream removes duplicates only behind the shuffle, so an identifier is first dealt
    over ``SPREAD`` groups by its rows: one that a third of all rows carry ends in no single
    task, and the second removal gets at most ``SPREAD`` rows of a name, once."""
    rows = spark.readStream.schema(CHECKED).parquet(f"{folder}/checked")
    part = F.pmod(F.xxhash64("ride_id", "started_at"), F.lit(SPREAD)).alias("part")
    names = rows.select(part, F.inline(roles_of(list(drift), across_roles)))
    known = names.where("id is not null and name is not null").distinct().drop("part").distinct()
    append_new(known, f"{folder}/names", f"{folder}/progress/names").awaitTermination()


def load_new_files(
    spark: SparkSession,
    root: str,
    folder: str,
    rules: list[Rule] | None = None,
    drift: tuple[Drift, ...] = TRIP_DRIFT,
    across_roles: bool = False,
    files_per_batch: int = 100,
) -> DataFrame:
    """Load the files of ``{root}/{year}/{month}`` that earlier calls have not loaded;
    returns ``flagged_so_far``.

    ``folder`` must be shared by all executors and belongs to one set of rules and drift
    checks. A call that dies is made good by the next: each stream goes on from its own
    progress, and a batch that was written in part is not seen."""
    append_checked(spark, root, folder, rules, files_per_batch)
    if drift:
        append_names(spark, folder, drift, across_roles)
    return flagged_so_far(spark, folder, drift, across_roles)


def flagged_so_far(
    spark: SparkSession, folder: str, drift: tuple[Drift, ...] = TRIP_DRIFT, across_roles: bool = False
) -> DataFrame:
    """All rows loaded so far with ``is_bad`` and ``failed_rules``, as ``flag`` gives them
    for one load of the same files, and year and month."""
    checked = spark.read.schema(CHECKED).parquet(f"{folder}/checked")
    if not drift:
        return checked
    roles = checked.select(F.inline(roles_of(list(drift), across_roles))).schema
    names = spark.read.schema(roles).parquet(f"{folder}/names")
    drifting = store(of_several_names(names), "drift")
    marked, late = with_drift(checked, list(drift), across_roles, drifting)
    return marked.select(
        *[c for c in checked.columns if c not in ("is_bad", "failed_rules")],
        (F.col("is_bad") | any_failing(late)).alias("is_bad"),
        F.concat("failed_rules", failing_names(late)).alias("failed_rules"),
    )
