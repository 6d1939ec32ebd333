"""The date dimension with holiday context."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.scalars import COUNTRY_LABELS, labelled
from ridestrata.functions.timezones import LOCAL_TZ, local_date

DATE_COLUMNS = (
    "Date",
    "Day",
    "Is_holiday",
    "Holiday_count",
    "Long_weekend",
    "Mini_vac_blocker",
    "Holiday",
    "Country",
)


def trip_dates(trips: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """The local dates on which trips started."""
    return trips.select(local_date(F.col("start_time"), tz).alias("date")).distinct()


def holiday_lists(holidays: DataFrame) -> DataFrame:
    """Per date the holidays and their countries, as two aligned lists in the
    order of the country label. A holiday entered twice counts once, so a list is
    no longer than the calendars of all countries allow."""
    entry = F.struct(labelled(F.col("country"), COUNTRY_LABELS).alias("country"), "holiday_name")
    return (
        holidays.select("country", "holiday_date", "holiday_name")
        .distinct()
        .groupBy(F.col("holiday_date").alias("date"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(
            "date",
            F.col("entries.holiday_name").alias("holiday_names"),
            F.col("entries.country").alias("holiday_countries"),
            F.size("entries").alias("holiday_count"),
        )
    )


def date_dim(
    dates: DataFrame, holidays: DataFrame, weekend_is_holiday: bool = False
) -> DataFrame:
    """One row per date; the lists are NULL on ordinary days.

    A holiday next to a weekend (Friday, Monday) makes a long weekend; one on
    Tuesday or Thursday leaves a working day between.
    """
    day = F.date_format("date", "EEEE")
    dated = dates.join(holiday_lists(holidays), "date", "left").withColumn("day", day)
    holiday = F.col("holiday_count").isNotNull()
    off = holiday | F.col("day").isin("Saturday", "Sunday") if weekend_is_holiday else holiday
    return dated.select(
        F.col("date"),
        F.col("day"),
        off.cast("int"),
        F.coalesce("holiday_count", F.lit(0)),
        (holiday & F.col("day").isin("Friday", "Monday")).cast("int"),
        (holiday & F.col("day").isin("Tuesday", "Thursday")).cast("int"),
        F.col("holiday_names"),
        F.col("holiday_countries"),
    ).toDF(*DATE_COLUMNS)
