from datetime import date, datetime, timezone

from ridestrata.operators.weather import CELL, WEATHER_COLUMNS, daily_with_weather, trips_in_weather, weather_dim
from tests.trips import cells

DAYS = "latitude double, longitude double, Date date, " + ", ".join(f"{c} float" for c in WEATHER_COLUMNS[1:])
D = date(2024, 1, 5)


def weather(spark, *rows):
    """Rows of (latitude, longitude, day, warmest); the rest of the values is the same."""
    return spark.createDataFrame([(*row, *[1.0] * (len(WEATHER_COLUMNS) - 2)) for row in rows], DAYS)


def test_one_location_answers_for_a_cell(spark):
    days = weather(
        spark,
        (38.9, -77.0, D, 3.0),  # centre of its cell
        (38.94, -77.0, D, 9.0),
        (38.9, -77.0, D, 2.0),  # twice for a day: the smaller value
        (39.06, -77.0, D, 5.0),
        (38.94, -77.0, date(2024, 1, 6), 8.0),
        (None, -77.0, D, 7.0),
        (38.9, -77.0, None, 7.0),
    )
    dim = weather_dim(days, 0.1)
    assert sorted(cells(dim, *CELL, "Date", "Temp_max")) == [
        (389, -770, D, 2.0),
        (389, -770, date(2024, 1, 6), 8.0),
        (391, -770, D, 5.0),
    ]


def test_trips_and_days_without_weather_stay(spark):
    at = datetime(2024, 1, 5, 17, tzinfo=timezone.utc)
    late = datetime(2024, 1, 6, 3, tzinfo=timezone.utc)  # still the 5th in Washington
    other = datetime(2024, 1, 9, 12, tzinfo=timezone.utc)
    trips = spark.createDataFrame(
        [(at, 38.91, -77.01), (late, 38.88, -76.99), (at, 10.0, 10.0), (at, None, -77.0), (other, 38.9, -77.0)],
        "start_time timestamp, start_lat double, start_lng double",
    )
    dim = weather_dim(weather(spark, (38.9, -77.0, D, 3.0)), 0.1)
    met = trips_in_weather(trips, dim, 0.1)
    assert sorted(cells(met, "Date", "cell_lat", "trips", "Temp_max"), key=str) == sorted(
        [(D, 389, 2, 3.0), (D, 100, 1, None), (D, None, 1, None), (date(2024, 1, 9), 389, 1, None)], key=str
    )
    daily = spark.createDataFrame([(D, 4), (date(2024, 1, 9), 1), (date(2024, 1, 10), 0)], "day date, trips int")
    rows = daily_with_weather(daily, met)
    assert sorted(cells(rows, "day", "trips", "trips_with_weather", "warmest"), key=str) == sorted(
        [(D, 4, 2, 3.0), (date(2024, 1, 9), 1, 0, None), (date(2024, 1, 10), 0, None, None)], key=str
    )


def test_no_weather_at_all(spark):
    trips = spark.createDataFrame([], "start_time timestamp, start_lat double, start_lng double")
    assert trips_in_weather(trips, weather_dim(weather(spark))).count() == 0
