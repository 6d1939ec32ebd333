"""Ridership answers from one stored aggregate instead of the fact.

A cube row counts the trips of a local day and hour, start station, rider type and bike
type, with the sum of their microseconds. Cubes of disjoint trips are merged by adding
their rows, so the stored cube is kept by feed month and only touched months are counted
anew. Stations are part of the grain: the number of distinct ones stays exact over any
range of days, and adds up without the trips. All answers equal those of
``ridestrata.plans.ridership`` over the trips.
"""

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.timezones import LOCAL_TZ, local_date, local_hour
from ridestrata.plans.ridership import MONTH_COLUMN, mean_minutes, with_calendar
from ridestrata.plans.star import top_totals

GRAIN = ("day", "hour", "start_stn_id", "rider_type", "rideable_type")
MICROS = "decimal(38,0)"


def ridership_cube(trips: DataFrame, by: tuple[str, ...] = (), tz: str = LOCAL_TZ) -> DataFrame:
    """(*by, *GRAIN, trips, timed, micros) of a fact. Trips without both times count in
    ``trips`` alone; trips without a start have neither day nor hour."""
    start = F.col("start_time")
    micros = F.unix_micros("end_time") - F.unix_micros("start_time")
    keys = {"day": local_date(start, tz), "hour": local_hour(start, tz)}
    return (
        trips.withColumns({**keys, "_micros": micros})
        .groupBy(*by, *GRAIN)
        .agg(
            F.count("*").alias("trips"),
            F.count("_micros").alias("timed"),
            F.coalesce(F.sum(F.col("_micros").cast("decimal(18,0)")), F.lit(0)).cast(MICROS).alias("micros"),
        )
    )


def merged_cubes(*cubes: DataFrame) -> DataFrame:
    """One cube of the trips of all of them."""
    rows = reduce(DataFrame.unionByName, (cube.select(*GRAIN, "trips", "timed", "micros") for cube in cubes))
    sums = [F.sum(name).cast(kind).alias(name) for name, kind in (("trips", "long"), ("timed", "long"), ("micros", MICROS))]
    return rows.groupBy(*GRAIN).agg(*sums)


def scoped(cube: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows of a range of local days; a stored cube with the month column is pruned by it."""
    for column, low, high in ((MONTH_COLUMN, start and start.replace(day=1), end and end.replace(day=1)), ("day", start, end)):
        if column in cube.columns:
            if low is not None:
                cube = cube.where(F.col(column) >= F.lit(low))
            if high is not None:
                cube = cube.where(F.col(column) <= F.lit(high))
    return cube


def _trips(where: Column | None = None) -> Column:
    counted = F.col("trips") if where is None else F.when(where, F.col("trips")).otherwise(0)
    return F.coalesce(F.sum(counted), F.lit(0))


def kpis(cube: DataFrame, start: date | None = None, end: date | None = None, approximate: bool = False) -> DataFrame:
    """``ridership.kpis``; ``approximate`` counts the stations by a sketch."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    sums = scoped(cube, start, end).agg(
        _trips().alias("trips"),
        _trips(F.col("rider_type") == "member").alias("member_trips"),
        F.sum("micros").alias("micros"),
        F.sum("timed").alias("timed"),
        distinct("start_stn_id").alias("stations_used"),
    )
    minutes = F.when(F.col("timed") > 0, mean_minutes(F.col("micros"), F.col("timed")))
    return sums.select("trips", "member_trips", minutes.alias("avg_minutes"), "stations_used")


def hourly(cube: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """``ridership.hourly``."""
    kinds = {name: _trips(F.col("rider_type") == name).alias(name) for name in ("member", "casual")}
    return scoped(cube, start, end).groupBy("hour").agg(*kinds.values()).orderBy("hour")


def trips_per_day(cube: DataFrame) -> DataFrame:
    return cube.groupBy("day").agg(_trips().alias("trips"))


def daily(cube: DataFrame, dates: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """``ridership.daily``."""
    days = with_calendar(trips_per_day(scoped(cube, start, end)), dates)
    flags = [F.coalesce(name, F.lit(0)).alias(name) for name in ("is_holiday", "long_weekend")]
    return days.select("day", "trips", *flags, "holiday_names", "holiday_countries").orderBy("day")


def top_stations(
    cube: DataFrame, stations: DataFrame, limit: int = 10, start: date | None = None, end: date | None = None
) -> DataFrame:
    """``ridership.top_stations``."""
    known = scoped(cube, start, end).where(F.col("start_stn_id").isNotNull())
    totals = known.groupBy(F.col("start_stn_id").alias("stn_id")).agg(_trips().alias("departures"))
    return top_totals(totals, stations, "stn_id", ["stn_name", "lat", "lng"], limit, "departures")


def bike_mix(cube: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """``ridership.bike_mix``."""
    mix = scoped(cube, start, end).groupBy("rideable_type").agg(_trips().alias("trips"))
    return mix.orderBy(F.desc("trips"), "rideable_type")


def trip_range(cube: DataFrame) -> DataFrame:
    """``ridership.trip_range``."""
    return cube.agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"), _trips().alias("trips"))


def holiday_effect(cube: DataFrame, dates: DataFrame) -> DataFrame:
    """``ridership.holiday_effect``."""
    days = with_calendar(trips_per_day(cube), dates)
    kind = F.when(F.coalesce("is_holiday", F.lit(0)) == 1, "Holiday").otherwise("Ordinary")
    return days.groupBy(kind.alias("day_kind")).agg(
        F.round(F.avg("trips"), 0).alias("avg_trips"), F.count("*").alias("days")
    )
