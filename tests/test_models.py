from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridestrata.operators import datatests as dt
from ridestrata.operators.calendar import DATE_COLUMNS, date_dim, holiday_lists, trip_dates
from ridestrata.operators.conform import (
    FACT_COLUMNS,
    fact,
    only_in_second_role,
    role_union_dim,
    to_silver,
)
from ridestrata.operators.profile import duration_profile, exact_quantiles
from ridestrata.operators.quarantine import flag
from ridestrata.operators.rules import ride_micros
from ridestrata.operators.weather import time_steps, weather_daily
from ridestrata.plans import ridership
from ridestrata.schemas import HOLIDAYS, WEATHER_VARIABLES
from ridestrata.sources.weather_files import read_weather, weather_request
from tests.trips import bronze, cells


def test_silver_types_and_values(spark):
    silver = to_silver(flag(bronze(spark, {"start_lat": 38.123455, "start_station_id": 31000.0})))
    row = silver.first()
    assert row.start_lat == Decimal("38.12346") and row.start_stn_id == 31000
    assert dict(silver.dtypes)["start_time"] == "timestamp"
    assert dict(silver.dtypes)["start_lat"].endswith(",5)")
    assert silver.select(F.unix_seconds("start_time")).first()[0] == 1704891600
    assert fact(silver).columns == list(FACT_COLUMNS)


def test_dimension_unites_roles_and_orders_nulls_last(spark):
    df = spark.createDataFrame(
        [
            (1, "B", None, None, 2, "Z", 1.0, 1.0),
            (1, "A", None, 5.0, 1, "A", 2.0, 4.0),
            (None, "N", 1.0, 1.0, 3, None, 1.0, 1.0),
            (1, "A", 2.0, 3.0, 3, "C", None, None),
        ],
        "start_stn_id int, start_stn_name string, start_lat double, start_lng double,"
        "end_stn_id int, end_stn_name string, end_lat double, end_lng double",
    )
    found = sorted(cells(role_union_dim(df), "stn_id", "stn_name", "lat", "lng"))
    assert found == [(1, "A", 2.0, 3.0), (2, "Z", 1.0, 1.0), (3, "C", None, None)]
    only = only_in_second_role(df, "start_stn_id", "end_stn_id", "stn_id")
    assert sorted(cells(only, "stn_id")) == [(2,), (3,)]


def test_dimension_ranks_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([(1, "a", 1.0, 1.0)] * 3, "k int, n string, x double, y double")
    role_union_dim(df, (("k", "n", "x", "y"),)).explain()
    plan = capsys.readouterr().out
    before = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_data_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "c")], "k int, v string")
    assert cells(dt.unique(df, "k"), "k", "n_rows") == [(1, 2)]
    assert dt.not_null(df, "k").count() == 2
    assert cells(dt.accepted_values(df, "v", ["a", "b"]), "v", "n_rows") == [("c", 1)]
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert cells(dt.relationships(df, "k", parent, "id"), "k", "n_rows") == [(2, 1)]
    tests = [dt.DataTest("fine", df.where("false")), dt.DataTest("broken", df)]
    assert dt.failing(tests) == ["broken"]
    with pytest.raises(dt.DataTestsFailed, match="broken"):
        dt.gate(tests)
    dt.gate(tests[:1])


def test_relationship_counts_before_the_join(spark, capsys):
    df = spark.range(10).withColumnRenamed("id", "k")
    dt.relationships(df, "k", spark.range(3), "id").explain()
    assert "LeftAnti" in capsys.readouterr().out


@pytest.fixture()
def holidays(spark):
    return spark.createDataFrame(
        [
            ("US", date(2024, 1, 1), "New Year"),
            ("CA", date(2024, 1, 1), "New Year"),
            ("CA", date(2024, 1, 1), "New Year"),
            ("US", date(2024, 1, 2), "Tuesday off"),
            ("FR", date(2024, 1, 5), "Friday off"),
        ],
        HOLIDAYS,
    )


def test_holiday_lists_are_aligned(spark, holidays):
    first = holiday_lists(holidays).where("date = '2024-01-01'").first()
    assert first.holiday_countries == ["Canada", "United States"]
    assert first.holiday_names == ["New Year", "New Year"] and first.holiday_count == 2


def test_date_dim(spark, holidays):
    dates = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3, 5, 6)], "date date")
    table = date_dim(dates, holidays)
    assert tuple(table.columns) == DATE_COLUMNS
    rows = {r.Date.day: r for r in table.collect()}
    assert [(d, r.Day, r.Is_holiday, r.Holiday_count, r.Long_weekend, r.Mini_vac_blocker) for d, r in sorted(rows.items())] == [
        (1, "Monday", 1, 2, 1, 0),
        (2, "Tuesday", 1, 1, 0, 1),
        (3, "Wednesday", 0, 0, 0, 0),
        (5, "Friday", 1, 1, 1, 0),
        (6, "Saturday", 0, 0, 0, 0),
    ]
    assert rows[3].Holiday is None and rows[3].Country is None and rows[5].Country == ["FR"]
    weekends = {r.Date.day: r.Is_holiday for r in date_dim(dates, holidays, True).collect()}
    assert weekends == {1: 1, 2: 1, 3: 0, 5: 1, 6: 1}


def weather_row(**changes):
    row = {"latitude": 38.8, "longitude": -77.1, "elevation": 10.0, "utc_offset_seconds": 0,
           "time": 1704067200, "time_end": 1704067200 + 2 * 86400, "interval_s": 86400}
    row.update({name: [float(i), float(i) + 0.5] for i, name in enumerate(WEATHER_VARIABLES)})
    return {**row, **changes}


def test_weather_keeps_every_location(spark, tmp_path):
    import json

    rows = [weather_row(), weather_row(latitude=38.9, rain_sum=[None, 9.0])]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(r) for r in rows))
    table = weather_daily(read_weather(spark, [str(tmp_path)]))
    found = sorted(cells(table, "latitude", "Date", "Temp_max", "Rain", "Wind_speed_max"), key=str)
    assert found == [
        (38.8, date(2024, 1, 1), 0.0, 2.0, 5.0),
        (38.8, date(2024, 1, 2), 0.5, 2.5, 5.5),
        (38.9, date(2024, 1, 1), 0.0, None, 5.0),
        (38.9, date(2024, 1, 2), 0.5, 9.0, 5.5),
    ]
    request = weather_request(date(2024, 1, 1), date(2024, 1, 2))
    assert request["bounding_box"] == "38.7916,-77.1197,38.9959,-76.9094"
    assert request["daily"].split(",") == list(WEATHER_VARIABLES)


def test_time_steps_are_half_open(spark):
    steps = spark.range(1).select(
        time_steps(F.lit(0).cast("bigint"), F.lit(7).cast("bigint"), F.lit(3)).alias("a"),
        time_steps(F.lit(0).cast("bigint"), F.lit(6).cast("bigint"), F.lit(3)).alias("b"),
        time_steps(F.lit(5).cast("bigint"), F.lit(5).cast("bigint"), F.lit(3)).alias("c"),
    ).first()
    assert (steps.a, steps.b, steps.c) == ([0, 3, 6], [0, 3], [])


@pytest.mark.parametrize(
    "values",
    [
        [9_007_207_844_675_583],
        [5, -3, 5, 5, 2**40, -(2**62), 2**62, 0],
        [7] * 100 + [-1, 70_000, 65_536, 65_535],
        list(range(-500, 100_000, 37)),
    ],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    shares = [0.0, 0.25, 0.99, 1.0]
    found = exact_quantiles(df, F.col("v"), shares)
    assert (found[0], found[-1]) == (min(values), max(values))
    expected = np.quantile(np.array(values, dtype=np.longdouble), shares)
    assert np.allclose(np.array(found, dtype=float), expected.astype(float))


def test_quantiles_of_nothing_and_profile(spark):
    empty = spark.createDataFrame([], "v bigint")
    assert exact_quantiles(empty, F.col("v"), [0.5]) == [None]
    df = bronze(spark, {}, {"ended_at": "2024-01-10 08:40:00"}, {"ended_at": None})
    row = duration_profile(df, ride_micros()).first()
    assert tuple(row) == (2, 30.0, 39.8, 40.0)


TRIPS = "ride_id string, rideable_type string, start_time timestamp, end_time timestamp, start_stn_id int, end_stn_id int, rider_type string"


@pytest.fixture()
def trips(spark):
    """Late evening trips belong to the local day, not to the UTC day."""
    def trip(i, start, minutes, station, rider, bike="classic_bike"):
        begin = datetime.fromisoformat(start)
        return (f"R{i}", bike, begin, begin.fromtimestamp(begin.timestamp() + minutes * 60), station, 1, rider)

    return spark.createDataFrame(
        [
            trip(0, "2024-01-10 13:00:00", 10, 1, "member"),
            trip(1, "2024-01-11 02:00:00", 20, 1, "casual"),  # 10 Jan 21:00 local
            trip(2, "2024-01-11 15:00:00", 33, 2, "member", "electric_bike"),
            trip(3, "2024-01-11 15:59:59", 0, 9, "guest", "electric_bike"),
            trip(4, "2024-01-12 15:00:00", 5, None, "member", "electric_bike"),
        ],
        TRIPS,
    )


@pytest.fixture()
def stations(spark):
    return spark.createDataFrame([(1, "A", 1.0, 1.0), (2, "B", 2.0, 2.0)], "stn_id int, stn_name string, lat double, lng double")


def test_range_and_kpis(trips):
    assert tuple(ridership.trip_range(trips).first()) == (date(2024, 1, 10), date(2024, 1, 12), 5)
    assert tuple(ridership.kpis(trips).first()) == (5, 3, 13.6, 3)
    assert tuple(ridership.kpis(trips, date(2024, 1, 10), date(2024, 1, 10)).first()) == (2, 1, 15.0, 1)
    assert tuple(ridership.kpis(trips, start=date(2024, 1, 12)).first()) == (1, 1, 5.0, 0)
    assert tuple(ridership.kpis(trips, end=date(2024, 1, 9)).first()) == (0, 0, None, 0)
    shares = [ridership.with_member_share(ridership.kpis(trips, end=e)).first()[-1] for e in (None, date(2020, 1, 1))]
    assert shares == [60.0, 0.0]


def test_hours_and_days_sum_to_trips(trips, spark, holidays):
    hours = ridership.with_hour_label(ridership.hourly(trips)).collect()
    assert [tuple(r) for r in hours] == [(8, 1, 0, "08"), (10, 2, 0, "10"), (21, 0, 1, "21")]
    dates = date_dim(trip_dates(trips), holidays)
    days = ridership.daily(trips, dates).collect()
    assert [(r.day.day, r.trips, r.is_holiday) for r in days] == [(10, 2, 0), (11, 2, 0), (12, 1, 0)]
    assert sum(r.trips for r in days) == trips.count()


def test_top_stations_and_mix(trips, stations):
    top = ridership.with_rank(ridership.top_stations(trips, stations)).collect()
    assert [(r.stn_id, r.departures, r.rank, r.share_of_max_pct) for r in top] == [(1, 2, 1, 100.0), (2, 1, 2, 50.0)]
    assert [r.stn_id for r in ridership.top_stations(trips, stations, limit=1).collect()] == [1]
    mix = ridership.bike_mix(trips).collect()
    assert [tuple(r) for r in mix] == [("electric_bike", 3), ("classic_bike", 2)]


def test_holiday_effect(trips, spark):
    off = spark.createDataFrame([("US", date(2024, 1, 11), "Day off")], HOLIDAYS)
    effect = ridership.holiday_effect(trips, date_dim(trip_dates(trips), off))
    assert sorted(cells(effect, "day_kind", "avg_trips", "days")) == [("Holiday", 2.0, 1), ("Ordinary", 2.0, 2)]


def test_weather_of_uneven_length_fails(spark, tmp_path):
    import json

    (tmp_path / "r.json").write_text(json.dumps(weather_row(rain_sum=[1.0, 2.0, 3.0])))
    with pytest.raises(Exception, match="another number of values"):
        weather_daily(read_weather(spark, [str(tmp_path)])).collect()
