"""Typed, renamed silver rows, the conformed dimension and the fact."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestrata.functions.scalars import rounded, whole_number
from ridestrata.functions.timezones import LOCAL_TZ, naive, wall_to_instant
from ridestrata.operators.quarantine import without_quarantined

FACT_COLUMNS = (
    "ride_id",
    "rideable_type",
    "start_time",
    "end_time",
    "start_stn_id",
    "end_stn_id",
    "rider_type",
)

STATION_COLUMNS = ("stn_id", "stn_name", "lat", "lng")
STATION_ROLES = (
    ("start_stn_id", "start_stn_name", "start_lat", "start_lng"),
    ("end_stn_id", "end_stn_name", "end_lat", "end_lng"),
)


def conform(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    """Rename, cast and round in one projection."""
    return df.select(*[expression.alias(name) for name, expression in mapping.items()])


def silver_mapping(tz: str = LOCAL_TZ) -> dict[str, Column]:
    mapping = {
        "ride_id": F.col("ride_id"),
        "rideable_type": F.col("rideable_type"),
        "start_time": wall_to_instant(naive(F.col("started_at")), tz),
        "end_time": wall_to_instant(naive(F.col("ended_at")), tz),
    }
    for side in ("start", "end"):
        mapping[f"{side}_stn_id"] = whole_number(F.col(f"{side}_station_id"))
        mapping[f"{side}_stn_name"] = F.col(f"{side}_station_name")
        mapping[f"{side}_lat"] = rounded(F.col(f"{side}_lat"), 5)
        mapping[f"{side}_lng"] = rounded(F.col(f"{side}_lng"), 5)
    mapping["rider_type"] = F.col("member_casual")
    return mapping


def to_silver(
    flagged: DataFrame, tz: str = LOCAL_TZ, strict: bool = True, key: str = "ride_id"
) -> DataFrame:
    return conform(without_quarantined(flagged, key, strict), silver_mapping(tz))


def kept_to_silver(kept: DataFrame, tz: str = LOCAL_TZ, also: tuple[str, ...] = ()) -> DataFrame:
    """Silver of rows that are known to be clean, with the columns ``also`` as they are."""
    return conform(kept, {**silver_mapping(tz), **{name: F.col(name) for name in also}})


def fact(df: DataFrame, columns: tuple[str, ...] = FACT_COLUMNS) -> DataFrame:
    return df.select(*columns)


def in_roles(
    df: DataFrame, roles: tuple[tuple[str, ...], ...], names: tuple[str, ...], also: tuple[str, ...] = ()
) -> DataFrame:
    """Each row once per role under common column names, in a single scan; the columns
    ``also`` come along."""
    per_role = [
        F.struct(*[F.col(source).alias(name) for source, name in zip(role, names)])
        for role in roles
    ]
    return df.select(*also, F.inline(F.array(*per_role)))


def role_union_dim(
    df: DataFrame,
    roles: tuple[tuple[str, ...], ...] = STATION_ROLES,
    names: tuple[str, ...] = STATION_COLUMNS,
) -> DataFrame:
    """One row per key (the first of ``names``) seen in any role.

    Of several versions of a key the smallest is kept, compared column by column
    with NULLs last. Equal rows collapse first, so few are ranked; Spark cuts the ranking to one row per key in every task before
    the shuffle, so a hot key does not gather in one task.
    """
    key, *versions = names
    order = [F.col(name).asc_nulls_last() for name in versions]
    first = Window.partitionBy(key).orderBy(*order)
    return (
        in_roles(df, roles, names)
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank")
    )


def only_in_second_role(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """Keys seen in the second role and never in the first."""
    roles = F.array(
        F.struct(F.col(first).alias(name), F.lit(True).alias("in_first")),
        F.struct(F.col(second).alias(name), F.lit(False).alias("in_first")),
    )
    return (
        df.select(F.inline(roles))
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.max("in_first").alias("in_first"))
        .where("not in_first")
        .select(name)
    )
