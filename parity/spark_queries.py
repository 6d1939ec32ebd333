"""The registered queries: every operator over whole driver tables."""

from collections.abc import Callable
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parity.landing import landed_csv, landed_malformed, landed_months, landed_zips, write_month, zipped
from parity.trips_fx import holiday_seed, trips_fx
from ridestrata.functions.scalars import COUNTRY_LABELS, labelled
from ridestrata.functions.timezones import (
    instant_to_wall,
    local_date,
    local_hour,
    naive,
    utc_naive,
    wall_to_instant,
)
from ridestrata.operators.calendar import date_dim, holiday_lists, trip_dates
from ridestrata.operators.conform import (
    STATION_ROLES,
    fact,
    only_in_second_role,
    role_union_dim,
    to_silver,
)
from ridestrata.operators.datatests import (
    accepted_values,
    failing,
    failures_by_test,
    not_null,
    relationships,
    silver_tests,
    unique,
)
from ridestrata.operators.profile import duration_profile, quantiles_by
from ridestrata.operators.quarantine import (
    bad_rows,
    clean_rows,
    excluding_keys,
    failure_counts,
    failures_long,
    flag,
    flagged_ratio_alarm,
    quarantine_ratio_alarm,
)
from ridestrata.operators.repair import (
    SIDES,
    merge_repaired,
    recovery_summary,
    repair_candidates,
    snap_to_nearest,
    snap_within,
)
from ridestrata.operators.rules import (
    TRIP_DRIFT,
    TRIP_TEXT,
    TRIP_VALUES,
    drifting_ids,
    required_text,
    required_value,
    ride_length,
    ride_micros,
)
from ridestrata.operators.stored import scratch_path, store
from ridestrata.operators.weather import arrays_to_rows, daily_with_weather, trips_in_weather, weather_daily, weather_dim
from ridestrata.plans import cube, ridership
from ridestrata.plans.monthly import MONTH, build_calendar, ingest, run_months, store_repaired, store_test_failures
from ridestrata.plans.star import counted, top_by_dimension, with_context
from ridestrata.schemas import TRIPS, WEATHER_VARIABLES
from ridestrata.sources.archive import month_key, read_readable_csv, read_readable_months, read_trip_archives, read_trip_csv, month_folder, unzip_trips
from ridestrata.sources.warehouse import (
    create_folder,
    create_layers,
    publish_view,
    read_model,
    replace_partitions,
    replace_table,
    run_sql,
    run_sql_file,
)
from ridestrata.sources.weather_files import read_weather
from ridestrata.streaming.quarantine import load_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FROM, TO = date(2024, 1, 5), date(2024, 1, 20)
AFTER_ALL = date(2030, 1, 1)


def plain(df: DataFrame) -> DataFrame:
    """Types that compare across engines: DOUBLE for decimals and floats, UTC wall
    clocks for instants, joined text for lists."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if field.name in ("started_at", "ended_at"):
            value = naive(value)
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = utc_naive(value)
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema])


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(spark, sf_dir))
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def silver(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return to_silver(flag(trips_fx(spark, sf_dir)), strict=strict)


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(silver(spark, sf_dir))


def calendar(spark: SparkSession, trips: DataFrame) -> DataFrame:
    return date_dim(trip_dates(trips), holiday_seed(spark))


def quarantined_and_stations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    flagged = flag(trips_fx(spark, sf_dir))
    return bad_rows(flagged), role_union_dim(to_silver(flagged, strict=False))


# Bronze and rules


@query
def q_bronze_scan(spark, sf_dir):
    return trips_fx(spark, sf_dir)


@query
def q_rule_required(spark, sf_dir):
    rules = [*required_text(*TRIP_TEXT), *required_value(*TRIP_VALUES)]
    return bad_rows(flag(trips_fx(spark, sf_dir), rules, drift=()))


@query
def q_rule_duration(spark, sf_dir):
    return bad_rows(flag(trips_fx(spark, sf_dir), ride_length(), drift=()))


@query
def q_rule_drift_start(spark, sf_dir):
    return bad_rows(flag(trips_fx(spark, sf_dir), [], TRIP_DRIFT[:1]))


@query
def q_rule_drift_end(spark, sf_dir):
    return bad_rows(flag(trips_fx(spark, sf_dir), [], TRIP_DRIFT[1:]))


@query
def q_drifting_ids(spark, sf_dir):
    return drifting_ids(trips_fx(spark, sf_dir), list(TRIP_DRIFT))


@query
def q_drifting_ids_across_roles(spark, sf_dir):
    return drifting_ids(trips_fx(spark, sf_dir), list(TRIP_DRIFT), across_roles=True)


@query
def q_quarantine(spark, sf_dir):
    return bad_rows(flag(trips_fx(spark, sf_dir)))


@query
def q_clean(spark, sf_dir):
    return clean_rows(flag(trips_fx(spark, sf_dir)))


@query
def q_failed_rule_counts(spark, sf_dir):
    return failure_counts(bad_rows(flag(trips_fx(spark, sf_dir))))


@query
def q_failures_by_rule(spark, sf_dir):
    return failures_long(bad_rows(flag(trips_fx(spark, sf_dir))))


@query
def q_quarantine_ratio(spark, sf_dir):
    trips = trips_fx(spark, sf_dir)
    return quarantine_ratio_alarm(bad_rows(flag(trips)), trips, highest=0.25)


@query
def q_quarantine_ratio_passes(spark, sf_dir):
    trips = trips_fx(spark, sf_dir)
    return quarantine_ratio_alarm(bad_rows(flag(trips)), trips)


# Silver and the star schema


@query
def q_silver_parity(spark, sf_dir):
    return silver(spark, sf_dir)


@query
def q_silver_strict(spark, sf_dir):
    return silver(spark, sf_dir, strict=True)


@query
def q_anti_join(spark, sf_dir):
    trips = trips_fx(spark, sf_dir)
    return excluding_keys(trips, bad_rows(flag(trips)), "ride_id")


@query
def q_dim_station(spark, sf_dir):
    return role_union_dim(silver(spark, sf_dir))


@query
def q_destination_only(spark, sf_dir):
    origin, destination = (role[0] for role in STATION_ROLES)
    return only_in_second_role(silver(spark, sf_dir), origin, destination, "stn_id")


@query
def q_fact(spark, sf_dir):
    return gold_fact(spark, sf_dir)


# Repair


def _snapped(spark, sf_dir, side):
    bad, stations = quarantined_and_stations(spark, sf_dir)
    near, metres = f"{side.name}_near_stn", side.metres
    rows = snap_to_nearest(bad, stations, side).where(F.col(metres).isNotNull())
    return rows.select("ride_id", side.lat, side.lng, near, metres)


@query
def q_snap_start(spark, sf_dir):
    return _snapped(spark, sf_dir, SIDES[0])


@query
def q_snap_end(spark, sf_dir):
    return _snapped(spark, sf_dir, SIDES[1])


@query
def q_snap_within_radius(spark, sf_dir):
    bad, stations = quarantined_and_stations(spark, sf_dir)
    side = SIDES[0]
    near, metres = f"{side.name}_near_stn", side.metres
    rows = snap_within(bad, stations, side, 50).where(F.col(metres).isNotNull())
    return rows.select("ride_id", side.lat, side.lng, near, metres)


@query
def q_repair(spark, sf_dir):
    return repair_candidates(*quarantined_and_stations(spark, sf_dir))


def merged(spark, sf_dir):
    flagged = flag(trips_fx(spark, sf_dir))
    kept = to_silver(flagged, strict=False)
    stations = store(role_union_dim(kept), "stations")
    return merge_repaired(kept, repair_candidates(bad_rows(flagged), stations), stations)


@query
def q_merge_repaired(spark, sf_dir):
    return merged(spark, sf_dir)


@query
def q_kpis_repaired(spark, sf_dir):
    return ridership.kpis(merged(spark, sf_dir))


@query
def q_recovery_summary(spark, sf_dir):
    flagged = flag(trips_fx(spark, sf_dir))
    stations = role_union_dim(to_silver(flagged, strict=False))
    return recovery_summary(flagged, repair_candidates(bad_rows(flagged), stations))


# Ridership


@query
def q_range(spark, sf_dir):
    return ridership.trip_range(gold_fact(spark, sf_dir))


@query
def q_kpis(spark, sf_dir):
    return ridership.kpis(gold_fact(spark, sf_dir))


@query
def q_kpis_bounded(spark, sf_dir):
    kpis = ridership.kpis(gold_fact(spark, sf_dir), FROM, TO)
    return ridership.with_member_share(kpis)


@query
def q_kpis_empty(spark, sf_dir):
    kpis = ridership.kpis(gold_fact(spark, sf_dir), AFTER_ALL)
    return ridership.with_member_share(kpis)


@query
def q_hourly(spark, sf_dir):
    return ridership.hourly(gold_fact(spark, sf_dir))


@query
def q_hourly_bounded(spark, sf_dir):
    return ridership.with_hour_label(ridership.hourly(gold_fact(spark, sf_dir), FROM, TO))


@query
def q_daily(spark, sf_dir):
    trips = gold_fact(spark, sf_dir)
    return ridership.daily(trips, calendar(spark, trips))


@query
def q_daily_bounded(spark, sf_dir):
    trips = gold_fact(spark, sf_dir)
    return ridership.daily(trips, calendar(spark, trips), FROM, TO)


@query
def q_bike_mix(spark, sf_dir):
    return ridership.bike_mix(gold_fact(spark, sf_dir))


@query
def q_top_stations(spark, sf_dir):
    kept = silver(spark, sf_dir)
    return ridership.top_stations(fact(kept), role_union_dim(kept))


@query
def q_top_stations_bounded(spark, sf_dir):
    kept = silver(spark, sf_dir)
    top = ridership.top_stations(fact(kept), role_union_dim(kept), 25, FROM, TO)
    return ridership.with_rank(top)


@query
def q_holiday_effect(spark, sf_dir):
    trips = gold_fact(spark, sf_dir)
    return ridership.holiday_effect(trips, calendar(spark, trips))


@query
def q_duration_profile(spark, sf_dir):
    return duration_profile(trips_fx(spark, sf_dir), ride_micros())


@query
def q_duration_by_bike_and_day(spark, sf_dir):
    trips = trips_fx(spark, sf_dir).withColumn("day", F.to_date(naive(F.col("started_at"))))
    found = quantiles_by(trips, ["rideable_type", "day"], ride_micros(), [0.5, 0.9, 0.99])
    return found.select(
        "rideable_type",
        "day",
        F.col("n").alias("rides"),
        *[F.round(F.get("quantiles", F.lit(i)) / 1_000_000, 3).alias(f"{p}_seconds") for i, p in enumerate(("p50", "p90", "p99"))],
        F.round(F.col("largest") / 1_000_000, 3).alias("longest_seconds"),
    )


# The same from a cube that is merged month by month


def merged_cube(spark, sf_dir):
    """The cubes of the trips of every third day, merged."""
    trips = gold_fact(spark, sf_dir)
    third = F.pmod(F.dayofmonth(local_date(F.col("start_time"))), F.lit(3))
    cubes = [cube.ridership_cube(trips.where(third == k)) for k in range(3)]
    return store(cube.merged_cubes(*cubes), "cube")


@query
def q_cube_range(spark, sf_dir):
    return cube.trip_range(merged_cube(spark, sf_dir))


@query
def q_cube_kpis_bounded(spark, sf_dir):
    return ridership.with_member_share(cube.kpis(merged_cube(spark, sf_dir), FROM, TO))


@query
def q_cube_kpis_empty(spark, sf_dir):
    return ridership.with_member_share(cube.kpis(merged_cube(spark, sf_dir), AFTER_ALL))


@query
def q_cube_hourly_bounded(spark, sf_dir):
    return ridership.with_hour_label(cube.hourly(merged_cube(spark, sf_dir), FROM, TO))


@query
def q_cube_daily_bounded(spark, sf_dir):
    return cube.daily(merged_cube(spark, sf_dir), calendar(spark, gold_fact(spark, sf_dir)), FROM, TO)


@query
def q_cube_top_stations_bounded(spark, sf_dir):
    stations = role_union_dim(silver(spark, sf_dir))
    return ridership.with_rank(cube.top_stations(merged_cube(spark, sf_dir), stations, 25, FROM, TO))


@query
def q_cube_bike_mix(spark, sf_dir):
    return cube.bike_mix(merged_cube(spark, sf_dir))


@query
def q_cube_holiday_effect(spark, sf_dir):
    return cube.holiday_effect(merged_cube(spark, sf_dir), calendar(spark, gold_fact(spark, sf_dir)))


# Calendar and weather


@query
def q_date_dim(spark, sf_dir):
    return calendar(spark, gold_fact(spark, sf_dir))


@query
def q_date_dim_weekends(spark, sf_dir):
    dates = trip_dates(gold_fact(spark, sf_dir))
    return date_dim(dates, holiday_seed(spark), weekend_is_holiday=True)


def order_holidays(spark, sf_dir):
    """A holiday table with several countries per day, from the orders."""
    codes = F.array(*[F.lit(code) for code in COUNTRY_LABELS])
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.get(codes, (F.col("o_custkey") % len(COUNTRY_LABELS)).cast("int")).alias("country"),
            F.to_date("o_orderdate").alias("holiday_date"),
            F.col("o_orderpriority").alias("holiday_name"),
        )
        .distinct()
    )


@query
def q_holiday_lists(spark, sf_dir):
    return holiday_lists(order_holidays(spark, sf_dir))


@query
def q_weather_daily(spark, sf_dir):
    return weather_daily(weather_responses(spark, sf_dir))


@query
def q_weather_landed(spark, sf_dir):
    """Responses landed as JSON, read again and stored as a table that must be new."""
    path = scratch_path(spark, "weather-json")
    weather_responses(spark, sf_dir).write.json(path)
    return create_folder(weather_daily(read_weather(spark, [path])), scratch_path(spark, "weather"))


def weather_responses(spark, sf_dir):
    """A response per vector: each variable has all its values, begun at another one."""
    days, day = 64, 86_400
    start = F.lit(1_704_067_200).cast("bigint") + F.col("vec_id") % 5 * day
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 90).cast("double").alias("latitude"),
        F.col("vec_id").cast("double").alias("longitude"),
        start.alias("time"),
        (start + days * day).alias("time_end"),
        F.lit(day).alias("interval_s"),
        *[
            F.concat(F.slice("embedding", 1 + i * 10, days - i * 10), F.slice("embedding", 1, i * 10)).alias(name)
            for i, name in enumerate(WEATHER_VARIABLES)
        ],
    )


def local_weather(spark, sf_dir):
    """Responses of 35 locations among the stations, most of them with several, landed as
    JSON, read again and stored as a table that must be new: the weather by cell and day."""
    number = F.col("longitude").cast("bigint")
    responses = weather_responses(spark, sf_dir).withColumns(
        {
            "latitude": (3880 + number % 7 * 2).cast("double") / 100,
            "longitude": (F.floor(number / 7).cast("bigint") % 5 * 3 - 7710).cast("double") / 100,
        }
    )
    path = scratch_path(spark, "weather-json")
    responses.write.json(path)
    return create_folder(weather_dim(weather_daily(read_weather(spark, [path])), 0.02), scratch_path(spark, "weather"))


@query
def q_weather_cells(spark, sf_dir):
    return local_weather(spark, sf_dir)


@query
def q_trips_in_weather(spark, sf_dir):
    return trips_in_weather(silver(spark, sf_dir), local_weather(spark, sf_dir), 0.02)


@query
def q_daily_weather(spark, sf_dir):
    trips = silver(spark, sf_dir)
    met = trips_in_weather(trips, local_weather(spark, sf_dir), 0.02)
    return daily_with_weather(ridership.daily(trips, calendar(spark, trips)), met)


@query
def q_array_to_rows(spark, sf_dir):
    places = F.sequence(F.lit(1), F.size("embedding"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("place", places)
    return arrays_to_rows(vectors, ["vec_id", "label"], [F.col("place"), F.col("embedding")])


# Generic star queries and data tests


@query
def q_star_inner(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    suppliers = table(spark, sf_dir, "supplier").join(nations, "s_nationkey")
    return top_by_dimension(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        suppliers,
        "s_suppkey",
        ["s_name", "n_name"],
        20,
        "lines",
    )


@query
def q_star_left(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem")
    days = counted(shipped, F.to_date("l_shipdate"), "day", "lines")
    ordered = counted(
        table(spark, sf_dir, "orders"), F.to_date("o_orderdate"), "day", "orders"
    )
    return with_context(days, ordered, "day")


@query
def q_test_unique(spark, sf_dir):
    return unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def q_test_not_null(spark, sf_dir):
    return not_null(trips_fx(spark, sf_dir), "start_station_id")


@query
def q_test_accepted(spark, sf_dir):
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    return accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", priorities)


@query
def q_test_relationship(spark, sf_dir):
    builders = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return relationships(table(spark, sf_dir, "orders"), "o_custkey", builders, "c_custkey")


@query
def q_data_tests(spark, sf_dir):
    """The whole contract of silver: rows returned by each test."""
    flagged = flag(trips_fx(spark, sf_dir))
    kept = store(to_silver(flagged, strict=False), "silver")
    stations = store(role_union_dim(kept), "stations")
    return failures_by_test(silver_tests(kept, stations, flagged_ratio_alarm(flagged)))


# Expressions


def _shifted_events(spark, sf_dir):
    """Events moved over the days on which clocks go back and forward."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    autumn = events.select("event_id", F.lit("autumn").alias("season"), F.expr("ts - INTERVAL '67' DAY").alias("wall"))
    spring = events.select("event_id", F.lit("spring").alias("season"), F.expr("ts + INTERVAL '55' DAY").alias("wall"))
    return autumn.union(spring)


@query
def q_wall_clock(spark, sf_dir):
    instant = wall_to_instant(F.col("wall"))
    return _shifted_events(spark, sf_dir).select("*", instant.alias("instant")).select(
        "event_id",
        "season",
        "wall",
        "instant",
        instant_to_wall(F.col("instant")).alias("wall_again"),
        local_date(F.col("instant")).alias("local_day"),
        local_hour(F.col("instant")).alias("local_hour"),
    )


@query
def q_label_map(spark, sf_dir):
    codes = F.array(*[F.lit(code) for code in [*COUNTRY_LABELS, "FR", "DE"]])
    code = F.get(codes, (F.col("user_id") % (len(COUNTRY_LABELS) + 2)).cast("int"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(labelled(code, COUNTRY_LABELS).alias("country"))
        .agg(F.count("*").alias("events"))
    )


@query
def q_month_keys(spark, sf_dir):
    key = month_key(F.year("o_orderdate"), F.month("o_orderdate"))
    return counted(table(spark, sf_dir, "orders"), key, "month_key", "orders")


# Sources, sinks, SQL


@query
def q_zip_scan(spark, sf_dir):
    return unzip_trips(zipped(trips_fx(spark, sf_dir))).drop("path")


@query
def q_zip_folders(spark, sf_dir):
    """Zips in month folders, streamed."""
    root = landed_zips(trips_fx(spark, sf_dir), FEEDS)
    return read_trip_archives(spark, [month_folder(root, *month) for month in FEEDS])


@query
def q_readable_zips(spark, sf_dir):
    """The same with a number that is none in every trip of a type."""
    trips = trips_fx(spark, sf_dir)
    text = F.when(F.col("rideable_type") == "docked_bike", "north").otherwise(F.col("start_lat").cast("string"))
    root = landed_zips(trips.withColumn("start_lat", text), FEEDS)
    rows, unreadable = read_readable_months(spark, [month_folder(root, *month) for month in FEEDS])
    counts = [
        df.groupBy("year", "month").agg(F.count("*").alias("trips")).withColumn("readable", F.lit(flag))
        for df, flag in ((rows, True), (unreadable, False))
    ]
    return counts[0].union(counts[1])


@query
def q_csv_scan(spark, sf_dir):
    return read_trip_csv(spark, [landed_csv(trips_fx(spark, sf_dir))])


@query
def q_malformed_rows(spark, sf_dir):
    """The records that cannot be read, with their reasons."""
    _, unreadable = read_readable_csv(spark, [landed_malformed(trips_fx(spark, sf_dir))])
    return unreadable


@query
def q_readable_rows(spark, sf_dir):
    """The trips of the same files that can be read."""
    rows, _ = read_readable_csv(spark, [landed_malformed(trips_fx(spark, sf_dir))])
    return rows


@query
def q_create_only_sink(spark, sf_dir):
    path = scratch_path(spark, "created")
    return create_folder(trips_fx(spark, sf_dir), path)


@query
def q_overwrite_partition(spark, sf_dir):
    """Every second day is first loaded wrong and then loaded again."""
    path = scratch_path(spark, "replayed")
    day = F.to_date(naive(F.col("started_at")))
    trips = trips_fx(spark, sf_dir).withColumn("day", day)
    wrong = F.dayofmonth("day") % 2 == 0
    first = trips.withColumn("ride_id", F.when(wrong, "wrong").otherwise(F.col("ride_id")))
    replace_partitions(first, path, ("day",))
    replace_partitions(trips.where(wrong), path, ("day",))
    return spark.read.parquet(path).select(*TRIPS.names)


@query
def q_param_sql(spark, sf_dir):
    publish_view(table(spark, sf_dir, "events"), "trip_events")
    text = """
        SELECT event_type, count(*) AS events, round(max(value), 2) AS largest
        FROM trip_events
        WHERE (:first IS NULL OR ts >= :first) AND (:last IS NULL OR ts < :last)
        GROUP BY event_type
    """
    return run_sql(spark, text, first=FROM, last=None)


@query
def q_sql_file(spark, sf_dir):
    publish_view(table(spark, sf_dir, "events"), "trip_events")
    return run_sql_file(spark, str(Path(__file__).with_name("event_mix.sql")))


# The month run, over landed files and stored tables


FEEDS = {(2024, 1 + k): f"day(to_date(started_at)) % 3 = {k}" for k in range(3)}


def layers_and_files(spark, trips):
    create_layers(spark, location=scratch_path(spark, "layers"))
    return landed_months(trips, FEEDS)


@query
def q_month_run(spark, sf_dir):
    root = layers_and_files(spark, trips_fx(spark, sf_dir))
    built = run_months(spark, root, FEEDS, zipped=False, strict=False, tested=False)
    return store(built.silver, "silver")


@query
def q_gold_repaired(spark, sf_dir):
    root = layers_and_files(spark, trips_fx(spark, sf_dir))
    run_months(spark, root, FEEDS, zipped=False, strict=False, tested=False)
    store_repaired(spark)
    trips = read_model(spark, "gold", "fct_trips_repaired")
    return store(trips.drop(ridership.MONTH_COLUMN), "repaired")


@query
def q_backfill(spark, sf_dir):
    """The second month is first loaded wrong and then loaded again."""
    trips = trips_fx(spark, sf_dir)
    second = list(FEEDS)[1]
    wrong = F.when(F.expr(FEEDS[second]), "wrong").otherwise(F.col("ride_id"))
    ingest(spark, layers_and_files(spark, trips.withColumn("ride_id", wrong)), FEEDS, zipped=False)
    root = landed_months(trips, {second: FEEDS[second]})
    return store(ingest(spark, root, [second], zipped=False, keep_other_months=True), "bronze")


@query
def q_self_rebuild(spark, sf_dir):
    """A table loaded with rows too many, then rebuilt from itself without them."""
    create_layers(spark, location=scratch_path(spark, "layers"))
    trips = trips_fx(spark, sf_dir)
    wrong = trips.withColumn("ride_id", F.lit("wrong"))
    loaded = replace_table(trips.withColumn("extra", F.lit(0)).union(wrong.withColumn("extra", F.lit(1))), "silver", "rebuilt")
    return store(replace_table(loaded.where("extra = 0").drop("extra"), "silver", "rebuilt"), "rebuilt")


def built_by_month(spark, sf_dir):
    """Every month run by itself. The second one is first loaded with other station names
    and without its bad rows, and then again as it is."""
    trips = trips_fx(spark, sf_dir)
    first, second, third = FEEDS
    options = {"zipped": False, "strict": False, "tested": False}
    root = layers_and_files(spark, trips)
    wrong = trips.where("member_casual = 'member'").withColumns(
        {"start_station_name": F.lit("unnamed"), "ride_id": F.coalesce("ride_id", F.lit("none"))}
    )
    run_months(spark, root, [first], **options)
    run_months(spark, landed_months(wrong, {second: FEEDS[second]}), [second], keep_other_months=True, **options)
    run_months(spark, root, [third], keep_other_months=True, **options)
    return run_months(spark, root, [second], keep_other_months=True, **options)


@query
def q_months_one_by_one(spark, sf_dir):
    return store(built_by_month(spark, sf_dir).silver, "silver")


@query
def q_quarantine_by_month(spark, sf_dir):
    return store(built_by_month(spark, sf_dir).quarantine.drop(*MONTH), "quarantine")


@query
def q_streamed_quarantine(spark, sf_dir):
    """The months land one after the other, the last one first, and are streamed as they come."""
    trips = trips_fx(spark, sf_dir)
    folder = scratch_path(spark, "streamed")
    root = scratch_path(spark, "landed")
    for month in reversed(FEEDS):
        write_month(trips.where(FEEDS[month]), root, month)
        flagged = load_new_files(spark, root, folder)
    return store(bad_rows(flagged).drop(*MONTH), "quarantine")


@query
def q_stored_cube(spark, sf_dir):
    """KPIs from the stored cube of the month run."""
    run_months(spark, layers_and_files(spark, trips_fx(spark, sf_dir)), FEEDS, zipped=False, strict=False, tested=False)
    return store(cube.kpis(read_model(spark, "gold", "ridership_cube"), FROM, TO), "kpis")


@query
def q_calendar_sink(spark, sf_dir):
    """The calendar as the month run's plan stores it."""
    run_months(spark, layers_and_files(spark, trips_fx(spark, sf_dir)), FEEDS, zipped=False, strict=False, tested=False)
    return store(build_calendar(spark, holiday_seed(spark)), "calendar")


@query
def q_tested_run(spark, sf_dir):
    """A month run that its data tests let pass: every ride id stands for one trip."""
    trips = trips_fx(spark, sf_dir)
    again = store(trips.groupBy("ride_id").count().where("count > 1").select("ride_id"), "again")
    single = excluding_keys(trips, again, "ride_id")
    return store(run_months(spark, layers_and_files(spark, single), FEEDS, zipped=False, strict=True).silver, "silver")


@query
def q_failing_tests(spark, sf_dir):
    """The data tests that stop a month run over all trips."""
    root = layers_and_files(spark, trips_fx(spark, sf_dir))
    built = run_months(spark, root, FEEDS, zipped=False, strict=False, tested=False)
    return spark.createDataFrame([(name,) for name in failing(built.tests)], "test string")


@query
def q_test_failures(spark, sf_dir):
    """The failing values that a month run over all trips stores."""
    root = layers_and_files(spark, trips_fx(spark, sf_dir))
    built = run_months(spark, root, FEEDS, zipped=False, strict=False, tested=False)
    return store(store_test_failures(built), "test-failures")
