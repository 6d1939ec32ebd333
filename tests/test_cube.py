"""Answers from the cube against those from the trips."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ridestrata.operators.calendar import date_dim, trip_dates
from ridestrata.plans import cube, ridership
from ridestrata.schemas import HOLIDAYS

TRIPS = "ride_id string, rideable_type string, start_time timestamp, end_time timestamp, start_stn_id int, end_stn_id int, rider_type string"


def test_answers_from_merged_cubes(spark):
    rng = random.Random(1)

    def trip(i):
        start = datetime(2024, 1, 1, 3) + timedelta(minutes=rng.randrange(60_000))
        end = rng.choice([start + timedelta(seconds=rng.randrange(-50, 9000), microseconds=rng.randrange(10**6)), None])
        return (str(i), rng.choice("abc"), rng.choice([start, start, start, None]), end, rng.choice([1, 2, 3, 9, None]), 1, rng.choice(["member", "casual", None]))

    trips = spark.createDataFrame([trip(i) for i in range(800)], TRIPS).cache()
    stations = spark.createDataFrame([(i, f"S{i}", 1.0 * i, 2.0) for i in (1, 2, 3)], "stn_id int, stn_name string, lat double, lng double")
    dates = date_dim(trip_dates(trips.where("start_time is not null")), spark.createDataFrame([("US", date(2024, 1, 15), "MLK Day")], HOLIDAYS))
    parts = [trips.where(F.crc32("ride_id") % 3 == k) for k in range(3)]
    merged = cube.merged_cubes(*[cube.ridership_cube(part) for part in parts]).cache()
    assert merged.count() == cube.ridership_cube(trips).count() <= trips.count()
    same = lambda a, b: a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    for bounds in ((None, None), (date(2024, 1, 10), None), (date(2024, 1, 3), date(2024, 1, 20)), (date(2030, 1, 1), None)):
        assert same(cube.kpis(merged, *bounds), ridership.kpis(trips, *bounds))
        assert same(cube.hourly(merged, *bounds), ridership.hourly(trips, *bounds))
        assert same(cube.daily(merged, dates, *bounds), ridership.daily(trips, dates, *bounds))
        assert same(cube.top_stations(merged, stations, 2, *bounds), ridership.top_stations(trips, stations, 2, *bounds))
        assert same(cube.bike_mix(merged, *bounds), ridership.bike_mix(trips, *bounds))
    assert same(cube.trip_range(merged), ridership.trip_range(trips))
    assert same(cube.holiday_effect(merged, dates), ridership.holiday_effect(trips, dates))
    assert cube.kpis(merged, approximate=True).first()["stations_used"] == 4


def test_the_stored_cube_is_pruned(spark, tmp_path, capsys):
    trips = spark.createDataFrame([("a", "b", datetime(2024, m, 5, 12), datetime(2024, m, 5, 13), 1, 2, "member") for m in (1, 2)], TRIPS)
    by_month = cube.ridership_cube(ridership.with_month_column(trips), (ridership.MONTH_COLUMN,))
    by_month.write.partitionBy(ridership.MONTH_COLUMN).parquet(f"{tmp_path}/cube")
    found = cube.kpis(spark.read.parquet(f"{tmp_path}/cube"), date(2024, 2, 1), date(2024, 2, 29))
    assert found.first()["trips"] == 1
    found.explain("formatted")
    assert "start_month" in capsys.readouterr().out.split("PartitionFilters")[1].split("]")[0]
