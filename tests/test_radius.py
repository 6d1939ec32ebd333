"""The radius join against every pair."""

import math
import random

import pytest

from ridestrata.functions.spatial import LNG_SCALE, METRES_PER_DEGREE
from ridestrata.operators.radius import RadiusIndex
from ridestrata.operators.repair import SIDES, snap_within
from pyspark.sql import functions as F

DIM = "stn_id int, lat double, lng double"


def plain(points, stations, metres):
    found = []
    for number, lat, lng in points:
        best = None
        for stn_id, slat, slng in stations:
            if None not in (lat, lng, slat, slng) and not any(map(math.isnan, (lat, lng, slat, slng))):
                if max(map(abs, (lat, lng, slat, slng))) > 1e150 and (lat, lng) != (slat, slng):
                    continue
                dist = math.sqrt((lat - slat) ** 2 + ((lng - slng) * LNG_SCALE) ** 2)
                whole = math.floor(dist * METRES_PER_DEGREE + 0.5)
                if whole <= metres and (best is None or (dist, stn_id) < best[:2]):
                    best = (dist, stn_id, whole)
        found.append((number, *(best[1:] if best else (None, None))))
    return sorted(found)


def nearest(spark, points, stations, metres, long_list):
    rows = spark.createDataFrame(points, "n int, lat double, lng double")
    index = RadiusIndex(rows.select("lat", "lng"), spark.createDataFrame(stations, DIM), metres, long_list=long_list)
    found = index.with_nearest(rows, "lat", "lng", F.lit(True), "stn", "metres")
    return sorted((r["n"], r["stn"], None if r["metres"] is None else int(r["metres"])) for r in found.collect())


@pytest.mark.parametrize("seed, metres, long_list", [(1, 50, 64), (2, 50, 2), (3, 500, 3), (4, 1, 1)])
def test_every_pair(spark, seed, metres, long_list):
    rng = random.Random(seed)
    step = metres / METRES_PER_DEGREE

    def place():
        return 38.9 + rng.randrange(-6, 7) * step / 2 + rng.random() * step / 9, -77.0 + rng.randrange(-6, 7) * step / 2

    stations = [(i, *place()) for i in range(60)] + [(90, 38.9, None), (91, math.nan, 1.0), (5, *place()), (92, 4e7, -1e300)]
    points = [(i, *place()) for i in range(300)] + [(900, None, 1.0), (901, math.nan, 2.0), (902, 4e7, -1e300), (903, 1e300, 0.0)]
    points += [(1000 + i, *stations[i][1:]) for i in range(20)]
    assert nearest(spark, points, stations, metres, long_list) == plain(points, stations, metres)
    assert nearest(spark, points, [], metres, long_list) == [(n, None, None) for n in sorted(p[0] for p in points)]


def test_many_stations_in_one_cell(spark):
    rng = random.Random(9)
    stations = [(i, 38.9 + rng.random() / 9000, -77.0 + rng.random() / 9000) for i in range(800)]
    points = [(i, 38.9 + rng.random() / 9000, -77.0 + rng.random() / 9000) for i in range(300)]
    assert nearest(spark, points, stations, 50, 8) == plain(points, stations, 50)


def test_no_descent_in_the_plan(spark, capsys):
    bad = spark.createDataFrame([("a", None, 38.9, -77.0)], "ride_id string, start_station_id double, start_lat double, start_lng double")
    dim = spark.createDataFrame([(1, 38.9, -77.0001)], DIM)
    snapped = snap_within(bad, dim, SIDES[0])
    capsys.readouterr()
    snapped.explain()
    plan = capsys.readouterr().out
    assert [tuple(r)[-2:] for r in snapped.collect()] == [(1, 9)]
    assert plan.count("Join") == 1 and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
