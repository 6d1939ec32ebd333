"""Parameterised ridership queries over the star schema.

Bounds are inclusive local dates of the trip's start, None leaves them open.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestrata.functions.scalars import share_percent, two_digits
from ridestrata.functions.timezones import LOCAL_TZ, in_local_dates, local_date, local_hour
from ridestrata.plans.star import counted, top_by_dimension, with_context


MONTH_COLUMN = "start_month"


def with_month_column(trips: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Add the first day of the local start month, to partition a stored fact by."""
    return trips.withColumn(MONTH_COLUMN, F.trunc(local_date(F.col("start_time"), tz), "month"))


def scoped(
    trips: DataFrame, start: date | None = None, end: date | None = None, tz: str = LOCAL_TZ
) -> DataFrame:
    """Trips of a range of local days. A fact that has the month column is cut to
    the months of the range first, which prunes its folders."""
    if start is None and end is None:
        return trips
    if MONTH_COLUMN in trips.columns:
        month = F.col(MONTH_COLUMN)
        if start is not None:
            trips = trips.where(month >= F.lit(start.replace(day=1)))
        if end is not None:
            trips = trips.where(month <= F.lit(end.replace(day=1)))
    return trips.where(in_local_dates(F.col("start_time"), start, end, tz))


def mean_minutes(micros: Column, rides: Column) -> Column:
    """Mean minutes to one decimal, from decimals: sums of microseconds can pass
    the range of BIGINT."""
    return F.round(micros / (rides.cast("decimal(20,0)") * 60_000_000), 1).cast("double")


def trip_range(trips: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """First and last local date and the number of trips."""
    return trips.agg(
        F.min("start_time").alias("first"),
        F.max("start_time").alias("last"),
        F.count("*").alias("trips"),
    ).select(
        local_date(F.col("first"), tz).alias("min_date"),
        local_date(F.col("last"), tz).alias("max_date"),
        "trips",
    )


def kpis(
    trips: DataFrame, start: date | None = None, end: date | None = None, tz: str = LOCAL_TZ
) -> DataFrame:
    """One row: trips, member trips, mean minutes, and the number of distinct
    origin stations."""
    micros = F.unix_micros("end_time") - F.unix_micros("start_time")
    return (
        scoped(trips, start, end, tz)
        .agg(
            F.count("*").alias("trips"),
            F.count_if(F.col("rider_type") == "member").alias("member_trips"),
            F.sum(micros.cast("decimal(18,0)")).alias("micros"),
            F.count(micros).alias("timed"),
            F.count_distinct("start_stn_id").alias("stations_used"),
        )
        .select(
            "trips",
            "member_trips",
            F.when(F.col("timed") > 0, mean_minutes(F.col("micros"), F.col("timed"))).alias(
                "avg_minutes"
            ),
            "stations_used",
        )
    )


def with_member_share(kpi: DataFrame) -> DataFrame:
    """Add the members' share of all departures, in whole percent."""
    share = share_percent(F.col("member_trips"), F.col("trips"))
    return kpi.withColumn("member_share_pct", share)


def hourly(
    trips: DataFrame, start: date | None = None, end: date | None = None, tz: str = LOCAL_TZ
) -> DataFrame:
    """Departures per local hour by rider type; hours without trips are absent."""
    return (
        scoped(trips, start, end, tz)
        .groupBy(local_hour(F.col("start_time"), tz).alias("hour"))
        .agg(
            F.count_if(F.col("rider_type") == "member").alias("member"),
            F.count_if(F.col("rider_type") == "casual").alias("casual"),
        )
        .orderBy("hour")
    )


def with_hour_label(hours: DataFrame) -> DataFrame:
    return hours.withColumn("hour_label", two_digits(F.col("hour")))


def trips_per_day(trips: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    return counted(trips, local_date(F.col("start_time"), tz), "day", "trips")


def with_calendar(days: DataFrame, dates: DataFrame) -> DataFrame:
    """Days with their holidays, NULL on ordinary ones."""
    calendar = dates.select(
        F.to_date("Date").alias("day"),
        F.col("Is_holiday").alias("is_holiday"),
        F.col("Long_weekend").alias("long_weekend"),
        F.col("Holiday").alias("holiday_names"),
        F.col("Country").alias("holiday_countries"),
    )
    return with_context(days, calendar, "day")


def daily(
    trips: DataFrame,
    dates: DataFrame,
    start: date | None = None,
    end: date | None = None,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """Trips per local day with its holidays."""
    days = trips_per_day(scoped(trips, start, end, tz), tz)
    return (
        with_calendar(days, dates)
        .select(
            "day",
            "trips",
            F.coalesce("is_holiday", F.lit(0)).alias("is_holiday"),
            F.coalesce("long_weekend", F.lit(0)).alias("long_weekend"),
            "holiday_names",
            "holiday_countries",
        )
        .orderBy("day")
    )


def top_stations(
    trips: DataFrame,
    stations: DataFrame,
    limit: int = 10,
    start: date | None = None,
    end: date | None = None,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """The busiest origins; of equally busy ones the smaller id comes first.

    Trips are counted per station before they meet the station table.
    """
    trips = scoped(trips, start, end, tz)
    labels = ["stn_name", "lat", "lng"]
    return top_by_dimension(trips, "start_stn_id", stations, "stn_id", labels, limit, "departures")


def with_rank(top: DataFrame) -> DataFrame:
    """Add the rank and the share of the busiest station to a top-k result."""
    ranked = Window.orderBy(F.desc("departures"), "stn_id")
    busiest = F.max("departures").over(Window.partitionBy(F.lit(0)))
    return top.withColumns(
        {
            "rank": F.row_number().over(ranked),
            "share_of_max_pct": share_percent(F.col("departures"), busiest, 1),
        }
    ).orderBy("rank")


def bike_mix(
    trips: DataFrame, start: date | None = None, end: date | None = None, tz: str = LOCAL_TZ
) -> DataFrame:
    return (
        scoped(trips, start, end, tz)
        .groupBy("rideable_type")
        .agg(F.count("*").alias("trips"))
        .orderBy(F.desc("trips"), "rideable_type")
    )


def holiday_effect(trips: DataFrame, dates: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Mean trips per day on holidays and ordinary days, over days with trips."""
    days = with_calendar(trips_per_day(trips, tz), dates)
    kind = F.when(F.coalesce("is_holiday", F.lit(0)) == 1, "Holiday").otherwise("Ordinary")
    return days.groupBy(kind.alias("day_kind")).agg(
        F.round(F.avg("trips"), 0).alias("avg_trips"), F.count("*").alias("days")
    )
