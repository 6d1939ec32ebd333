"""The month run: files to bronze, quarantine, silver, star schema and tests."""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestrata.functions.timezones import LOCAL_TZ
from ridestrata.operators.calendar import date_dim, trip_dates
from ridestrata.operators.conform import (
    FACT_COLUMNS,
    STATION_COLUMNS,
    STATION_ROLES,
    fact,
    in_roles,
    kept_to_silver,
    role_union_dim,
)
from ridestrata.operators.datatests import DataTest, failure_rows, gate, not_empty, silver_tests
from ridestrata.operators.quarantine import bad_rows, failures_long, flag, quarantine_ratio_alarm, without_bad_keys
from ridestrata.operators.repair import SIDES, merge_repaired, repair_candidates
from ridestrata.operators.rules import TRIP_DRIFT, names_by_role, of_several_names
from ridestrata.operators.stored import lookup_join, store
from ridestrata.plans.cube import ridership_cube
from ridestrata.plans.ridership import MONTH_COLUMN, with_month_column
from ridestrata.sources.archive import (
    month_folder,
    read_readable_months,
    read_trip_archives,
    read_trip_csv_months,
    require_files,
)
from ridestrata.sources.versions import publish, stage
from ridestrata.sources.warehouse import (
    create_layers,
    of_months,
    read_model,
    replace_table,
)


Month = tuple[int, int]
MONTH = ("year", "month")


@dataclass(frozen=True)
class Warehouse:
    bronze: DataFrame
    quarantine: DataFrame
    silver: DataFrame
    stations: DataFrame
    fact: DataFrame
    candidates: DataFrame
    tests: list[DataTest]
    touched: set[Month]  #: feed months whose silver was written


def ingest(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    zipped: bool = True,
    keep_other_months: bool = False,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Load months into ``bronze.trips``. The table is replaced as a whole, or,
    with ``keep_other_months``, only in the months that are read. A month without
    files is an error, raised before anything is replaced. So is a malformed record,
    unless ``keep_unreadable``: then it goes to ``bronze.unreadable`` with its reasons,
    and both tables change together."""
    months = [(int(year), int(month)) for year, month in months]
    folders = [month_folder(root, year, month) for year, month in months]
    require_files(spark, folders, "*.zip" if zipped else "*.csv")
    stale = of_months(months) if keep_other_months else None
    if keep_unreadable:
        trips, unreadable = read_readable_months(spark, folders, zipped)
        rest = [stage(unreadable, "bronze", "unreadable", MONTH, stale)]
    else:
        trips, rest = (read_trip_archives if zipped else read_trip_csv_months)(spark, folders), []
    publish(stage(trips, "bronze", "trips", MONTH, stale), *rest)
    return read_model(spark, "bronze", "trips")


def in_months(months: Iterable[tuple[int, int]]) -> Column:
    """Rows of these feed months; a filter on partitions."""
    wanted = sorted(months)
    if not wanted:
        return F.lit(False)
    by_year: dict[int, list[int]] = {}
    for year, month in wanted:
        by_year.setdefault(year, []).append(month)
    return reduce(or_, ((F.col("year") == y) & F.col("month").isin(found) for y, found in by_year.items()))


def _months_of(df: DataFrame) -> set[Month]:
    return {(row["year"], row["month"]) for row in df.select(*MONTH).distinct().collect()}


def _stored(spark: SparkSession, layer: str, model: str) -> DataFrame | None:
    return read_model(spark, layer, model) if spark.catalog.tableExists(f"{layer}.{model}") else None


def _differing(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Rows that only one of two sets of distinct rows has."""
    both = before.withColumn("_n", F.lit(-1)).union(after.withColumn("_n", F.lit(1)))
    return store(both.groupBy(*before.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n"), label)


def build_models(
    spark: SparkSession,
    strict: bool = True,
    tz: str = LOCAL_TZ,
    loaded: Iterable[Month] | None = None,
) -> Warehouse:
    """Rebuild what lies below ``bronze.trips``, all of it or, with ``loaded``, what the
    newly loaded months change; either way the result is that of a full build.

    Quarantine, failures, silver, fact, cube and the stations seen are stored by feed month. A
    loaded month touches another one in two ways: a station id starts or stops to carry
    several names, which changes the flags of all its trips; or a ride id is quarantined,
    or no longer, of which the other month has a copy, which changes its silver. Names of
    stations by month are kept for the first, and for the second the ride ids of other
    months are read, and nothing else of them. Only touched months are written; the files
    of the others stay.

    The new versions of all tables are published together at the end, the station names
    that the next run compares with as the last. A run that dies before leaves every table
    as it was, and one that is run again comes to the same result. The fact is partitioned
    by local month, for queries with bounds, and by feed month."""
    bronze = read_model(spark, "bronze", "trips")
    full = loaded is None or not spark.catalog.tableExists("audit.station_names")
    first = _months_of(bronze) | set(loaded or ()) if full else set(loaded)

    # Drift, from the names by month: of the loaded months anew, of the others as stored.
    known = names_by_role(bronze.where(in_months(first)), list(TRIP_DRIFT), by=MONTH)
    names = stage(known, "audit", "station_names", MONTH, None if full else of_months(first))
    drifting = store(of_several_names(names.rows().select("role", "id", "name").distinct()), "drift")
    if not full:
        before = of_several_names(read_model(spark, "audit", "station_names").select("role", "id", "name").distinct())
        changed = _differing(before, drifting, "drift-changes")
        first |= _months_of(lookup_join(names.rows().select("role", "id", *MONTH), changed, ["role", "id"], "left_semi"))

    def replaced(df: DataFrame, layer: str, model: str, months: set[Month], by: tuple[str, ...] = MONTH):
        return stage(df, layer, model, by, None if full else of_months(months))

    flagged = flag(bronze.where(in_months(first)), drifting=drifting, judged_once=True)
    quarantine = replaced(bad_rows(flagged), "bronze", "quarantine", first)
    quarantined = quarantine.rows()
    newly_bad = quarantined.where(in_months(first))
    failures = replaced(failures_long(newly_bad).hint("rebalance", "failed_rule"), "audit", "failures", first, ("failed_rule", *MONTH))

    touched = set(first)
    if not full:
        keys = [rows.where(in_months(first) & F.col("ride_id").isNotNull()).select("ride_id").distinct() for rows in (read_model(spark, "bronze", "quarantine"), quarantined)]
        changed = _differing(*keys, "key-changes")
        others = bronze.where(~in_months(first)).select("ride_id", *MONTH)
        touched |= _months_of(lookup_join(others, changed, ["ride_id"], "left_semi"))

    if touched != first:
        flagged = flag(bronze.where(in_months(touched)), drifting=drifting, judged_once=True)
    kept = without_bad_keys(flagged, quarantined, "ride_id", strict)
    silver = replaced(kept_to_silver(kept, tz, MONTH), "silver", "trips", touched)
    rows = silver.rows().where(in_months(touched))
    trips = with_month_column(fact(rows, (*FACT_COLUMNS, *MONTH)), tz)
    trips = replaced(trips, "gold", "fct_trips", touched, (MONTH_COLUMN, *MONTH))
    cube = ridership_cube(trips.rows().where(in_months(touched)), (MONTH_COLUMN, *MONTH), tz)
    cube = replaced(cube, "gold", "ridership_cube", touched, (MONTH_COLUMN, *MONTH))
    seen = replaced(in_roles(rows, STATION_ROLES, STATION_COLUMNS, MONTH).distinct(), "silver", "stations_seen", touched)
    stations = stage(role_union_dim(seen.rows(), (STATION_COLUMNS,)), "gold", "dim_stations")

    # Candidates depend on their own quarantined rows and on all stations.
    repaired, old = set(first), None if full else _stored(spark, "gold", "dim_stations")
    if old is not None and not _differing(old, stations.rows(), "station-changes").isEmpty():
        repaired = _months_of(quarantined) | first
    candidates = repair_candidates(quarantined.where(in_months(repaired)), stations.rows())
    candidates = replaced(candidates, "silver", "temp", repaired)

    publish(silver, trips, cube, seen, stations, candidates, failures, quarantine, names)
    built = {new.model: read_model(spark, new.layer, new.model) for new in (silver, trips, stations, candidates, quarantine)}
    plain = built["trips"].drop(*MONTH)
    return Warehouse(
        bronze,
        built["quarantine"],
        plain,
        built["dim_stations"],
        built["fct_trips"],
        built["temp"],
        [
            *silver_tests(plain, built["dim_stations"], quarantine_ratio_alarm(built["quarantine"], bronze)),
            DataTest("bronze_not_empty", not_empty(bronze)),
            DataTest("silver_not_empty", not_empty(plain)),
        ],
        touched,
    )


def build_calendar(spark: SparkSession, holidays: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    dates = trip_dates(read_model(spark, "silver", "trips"), tz)
    return replace_table(date_dim(dates, holidays), "gold", "dim_date")


def store_repaired(spark: SparkSession, tz: str = LOCAL_TZ) -> DataFrame:
    """``silver.trips_repaired``: silver and the trips that could be repaired; and
    their star schema, ``gold.fct_trips_repaired`` with the flags of inferred
    stations and ``gold.dim_stations_repaired``."""
    merged = merge_repaired(
        read_model(spark, "silver", "trips").drop(*MONTH),
        read_model(spark, "silver", "temp"),
        read_model(spark, "gold", "dim_stations"),
        tz,
    )
    merged = replace_table(merged, "silver", "trips_repaired")
    trips = fact(merged, (*FACT_COLUMNS, *[side.imputed for side in SIDES]))
    replace_table(with_month_column(trips, tz), "gold", "fct_trips_repaired", (MONTH_COLUMN,))
    replace_table(role_union_dim(merged), "gold", "dim_stations_repaired")
    return merged


def store_test_failures(built: Warehouse) -> DataFrame:
    """``audit.test_failures``: the failing values of the data tests and their rows."""
    return replace_table(failure_rows(built.tests), "audit", "test_failures")


def rule_failures(spark: SparkSession, rule: str) -> DataFrame:
    """Stored failing rows of one rule, read from its partition alone."""
    return read_model(spark, "audit", "failures").where(F.col("failed_rule") == rule)


def run_months(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    zipped: bool = True,
    keep_other_months: bool = False,
    strict: bool = True,
    tested: bool = True,
    tz: str = LOCAL_TZ,
    keep_unreadable: bool = False,
) -> Warehouse:
    """Layers, ingest, models in the order of their dependencies, then the data
    tests, whose failures are stored in ``audit.test_failures`` and which raise when one
    of them fails. With ``keep_other_months`` only what the
    months change is rebuilt."""
    create_layers(spark)
    months = [(int(year), int(month)) for year, month in months]
    ingest(spark, root, months, zipped, keep_other_months, keep_unreadable)
    built = build_models(spark, strict, tz, months if keep_other_months else None)
    if tested:
        gate(built.tests, store_test_failures(built))
    return built


def run_month(spark: SparkSession, root: str, year: int, month: int, **options) -> Warehouse:
    return run_months(spark, root, [(year, month)], **options)
