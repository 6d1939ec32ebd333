"""Fixed schemas of the landed inputs. Nothing is ever inferred from the data:
a column that changes its type from month to month fails loudly instead."""

from pyspark.sql import types as T

TEXT, DOUBLE = T.StringType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIPS = _struct(
    ride_id=TEXT,
    rideable_type=TEXT,
    started_at=TEXT,
    ended_at=TEXT,
    start_station_name=TEXT,
    start_station_id=DOUBLE,
    end_station_name=TEXT,
    end_station_id=DOUBLE,
    start_lat=DOUBLE,
    start_lng=DOUBLE,
    end_lat=DOUBLE,
    end_lng=DOUBLE,
    member_casual=TEXT,
)

# The same columns before null tokens are removed and numbers are cast.
TRIPS_RAW = T.StructType([T.StructField(f.name, TEXT) for f in TRIPS])

HOLIDAYS = _struct(country=TEXT, holiday_date=T.DateType(), holiday_name=TEXT)

WEATHER_VARIABLES = (
    "temperature_2m_max",
    "apparent_temperature_max",
    "rain_sum",
    "showers_sum",
    "snowfall_sum",
    "wind_speed_10m_max",
)

WEATHER_RESPONSE = _struct(
    latitude=DOUBLE,
    longitude=DOUBLE,
    elevation=DOUBLE,
    utc_offset_seconds=T.IntegerType(),
    time=T.LongType(),
    time_end=T.LongType(),
    interval_s=T.IntegerType(),
    **{name: T.ArrayType(T.FloatType()) for name in WEATHER_VARIABLES},
)
