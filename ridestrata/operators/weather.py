"""Daily weather rows from responses that hold one positional array per variable."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.timezones import LOCAL_TZ, local_date
from ridestrata.operators.stored import lookup_join, store
from ridestrata.schemas import WEATHER_VARIABLES

WEATHER_COLUMNS = (
    "Date",
    "Temp_max",
    "Apparent_temp_max",
    "Rain",
    "Shower",
    "Snow",
    "Wind_speed_max",
)


def time_steps(start: Column, end: Column, seconds: Column) -> Column:
    """Epoch seconds from start (included) to end (excluded)."""
    steps = F.sequence(start, end - 1, seconds.cast("bigint"))
    return F.when(start < end, steps).otherwise(F.array().cast("array<bigint>"))


def arrays_to_rows(df: DataFrame, keys: list[str], arrays: list[Column]) -> DataFrame:
    """One row per array position, the keys repeated; arrays must be named."""
    return df.select(*keys, F.inline(F.arrays_zip(*arrays)))


def weather_daily(responses: DataFrame) -> DataFrame:
    """(latitude, longitude) and the daily columns, for every location. An array that
    is longer or shorter than the span of its response is an error."""
    steps = time_steps(F.col("time"), F.col("time_end"), F.col("interval_s"))
    uneven = reduce(or_, (F.size(name) != F.size(steps) for name in WEATHER_VARIABLES))
    message = F.lit("a weather variable has another number of values than its response has steps")
    steps = F.when(uneven, F.raise_error(message).cast("array<bigint>")).otherwise(steps)
    rows = arrays_to_rows(
        responses.withColumn("step", steps),
        ["latitude", "longitude"],
        [F.col(name) for name in ("step", *WEATHER_VARIABLES)],
    )
    day = F.date_from_unix_date(F.floor(F.col("step") / 86_400).cast("int"))
    return rows.select(
        "latitude", "longitude", day, *WEATHER_VARIABLES
    ).toDF("latitude", "longitude", *WEATHER_COLUMNS)


CELL = ("cell_lat", "cell_lng")
CELL_DEGREES = 0.125  #: about the distance of the places that the weather model answers for


def weather_cell(lat: Column, lng: Column, degrees: float = CELL_DEGREES) -> list[Column]:
    """The grid cell whose centre, a multiple of ``degrees``, is nearest to a place."""
    return [
        F.floor(place.cast("double") / degrees + 0.5).cast("bigint").alias(name)
        for place, name in zip((lat, lng), CELL)
    ]


def weather_dim(days: DataFrame, degrees: float = CELL_DEGREES) -> DataFrame:
    """One row per cell and day, its key, of the rows of ``weather_daily``. Of several
    locations in a cell the one nearest to its centre answers, then the one with the
    smaller latitude and longitude; of rows that a location has twice for a day the
    smaller values, from the left, a missing one before others. Rows without a place or a
    day are left out."""
    cells = [F.floor(F.col(name) / degrees + 0.5) for name in ("latitude", "longitude")]
    off = [F.col(name) / degrees - cell for name, cell in zip(("latitude", "longitude"), cells)]
    rows = days.dropna(subset=["latitude", "longitude", "Date"]).select(
        *weather_cell(F.col("latitude"), F.col("longitude"), degrees),
        "Date",
        F.struct((off[0] * off[0] + off[1] * off[1]).alias("away"), "latitude", "longitude", *WEATHER_COLUMNS[1:]).alias("row"),
    )
    nearest = rows.groupBy(*CELL, "Date").agg(F.min("row").alias("row"))
    return nearest.select(*CELL, "Date", *[F.col("row")[name].alias(name) for name in WEATHER_COLUMNS[1:]])


def trips_in_weather(
    trips: DataFrame,
    dim: DataFrame,
    degrees: float = CELL_DEGREES,
    tz: str = LOCAL_TZ,
    place: tuple[str, str] = ("start_lat", "start_lng"),
) -> DataFrame:
    """Trips per local day and weather cell of their start, with the weather of that cell
    and day, NULL where none is known: days and trips without a place stay. Trips are
    counted before they meet the weather, and only counts move."""
    day = local_date(F.col("start_time"), tz).alias("Date")
    cells = weather_cell(*[F.col(name) for name in place], degrees)
    counts = trips.select(day, *cells).groupBy("Date", *CELL).agg(F.count("*").alias("trips"))
    return lookup_join(counts, store(dim, "weather"), [*CELL, "Date"], "left")


def daily_with_weather(daily: DataFrame, met: DataFrame, day: str = "day") -> DataFrame:
    """Rows of ``daily`` with the day's trips of known weather, the warmest maximum and the
    most rain that a trip met, from ``trips_in_weather``. Days without weather stay."""
    known = F.col("Temp_max").isNotNull()
    per_day = met.groupBy(F.col("Date").alias(day)).agg(
        F.sum(F.when(known, F.col("trips")).otherwise(0)).alias("trips_with_weather"),
        F.max("Temp_max").alias("warmest"),
        F.max("Rain").alias("most_rain"),
    )
    return daily.join(per_day, day, "left")
