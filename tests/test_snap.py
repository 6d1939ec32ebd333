import math
import random

import pytest

from ridestrata.operators.snap import StationIndex
from pyspark.sql import functions as F

from ridestrata.operators.repair import (
    SIDES,
    merge_repaired,
    recovered,
    recovery_summary,
    repair_candidates,
    snap_to_nearest,
)
from ridestrata.operators.conform import role_union_dim, to_silver
from ridestrata.operators.quarantine import bad_rows, flag
from tests.trips import bronze, cells, ids

DIM = "stn_id int, stn_name string, lat decimal(18,5), lng decimal(18,5)"
METRE = 1 / 111_000


def brute_force(point, stations):
    lat, lng = point
    return min(
        (math.sqrt((lat - a) ** 2 + ((lng - b) * 0.778) ** 2), stn)
        for stn, a, b in stations
        if a is not None and b is not None
    )


def check(spark, points, stations, long_list=64):
    dim = spark.createDataFrame(
        [(s, a, b) for s, a, b in stations], "stn_id int, lat double, lng double"
    )
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)], "i int, lat double, lng double")
    index = StationIndex(rows.select("lat", "lng"), dim, long_list)
    found = index.with_nearest(rows, "lat", "lng", F.lit(True), "stn", "metres").collect()
    assert len(found) == len(points)
    for row in found:
        dist, stn = brute_force(points[row.i], stations)
        assert (row.stn, row.metres) == (stn, math.floor(dist * 111_000 + 0.5 + 1e-9)), points[row.i]
    return index


def test_city(spark):
    rng = random.Random(1)
    stations = [(i, round(rng.uniform(38.8, 39.0), 5), round(rng.uniform(-77.2, -76.9), 5)) for i in range(400)]
    points = [(rng.uniform(38.7, 39.1), rng.uniform(-77.3, -76.8)) for _ in range(1500)]
    check(spark, points, stations)


def test_crowded_and_far(spark):
    """Half the stations within a few metres, others across the map, points near
    and far: crowded cells are cut finer."""
    rng = random.Random(2)
    stations = [(i, round(38.9 + rng.uniform(0, 0.0008), 5), round(-77.0 + rng.uniform(0, 0.0008), 5)) for i in range(300)]
    stations += [(1000 + i, round(rng.uniform(-60, 70), 5), round(rng.uniform(-179, 179), 5)) for i in range(100)]
    points = [(38.9 + rng.uniform(-0.0002, 0.001), -77.0 + rng.uniform(-0.0002, 0.001)) for _ in range(600)]
    points += [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(200)]
    index = check(spark, points, stations, long_list=8)
    assert len(index.parts) > 1


def test_ties_and_equal_places(spark):
    stations = [(5, 38.9, -77.0), (3, 38.9, -77.0), (9, 38.9002, -77.0), (1, None, None), (2, 38.9, None)]
    points = [(38.9, -77.0), (38.9001, -77.0), (0.0, 0.0)]
    check(spark, points, stations)


def test_single_station_everywhere(spark):
    check(spark, [(38.9, -77.0), (-33.9, 151.2), (89.9, 179.9), (-89.9, -179.9)], [(1, 38.9, -77.0)])


def test_no_station_and_off_the_map(spark):
    rows = spark.createDataFrame([(38.9, -77.0)], "lat double, lng double")
    none = spark.createDataFrame([], "stn_id int, lat double, lng double")
    found = StationIndex(rows, none).with_nearest(rows, "lat", "lng", F.lit(True), "stn", "m").first()
    assert found.stn is None and found.m is None
    dim = spark.createDataFrame([(1, 1.0, 1.0)], "stn_id int, lat double, lng double")
    off = spark.createDataFrame([(float("nan"), 0.0), (None, 0.0), (1e11, 0.0), (1.0, 1.0), (1e9, 1.0)], "lat double, lng double")
    found = StationIndex(off, dim).with_nearest(off, "lat", "lng", F.lit(True), "stn", "m").collect()
    assert [(r.stn, r.m) for r in found] == [(None, None)] * 3 + [(1, 0), (1, (10**9 - 1) * 111_000)]


def test_mistyped_places(spark):
    """Points and stations off the map, some by a lost decimal point."""
    rng = random.Random(3)
    stations = [(i, round(rng.uniform(38.8, 39.0), 5), round(rng.uniform(-77.2, -76.9), 5)) for i in range(60)]
    points = [(rng.uniform(38.8, 39.0) * scale, rng.uniform(-77.2, -76.9)) for scale in (1, 10, 100, 10_000, 10**6, 10**8) for _ in range(50)]
    points += [(38.9, -180.5), (389.0, -771.0), (-389.0, 771.0)]
    assert len(check(spark, points, stations).parts) == 1
    # Stations off the map leave the lists of the others as they are.
    check(spark, points, [*stations, (70, 389.0, -77.0), (71, 38.9, 77000.0), (72, 3.89e7, -7.7e9)])


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([(1, "A", 38.9, -77.0), (2, "B", 38.91, -77.01)], "stn_id int, stn_name string, lat double, lng double")


def lost_start(metres, **more):
    return {
        "start_station_id": None,
        "start_station_name": None,
        "start_lat": 38.9 + metres * METRE,
        "start_lng": -77.0,
        **more,
    }


@pytest.mark.parametrize("metres, snapped", [(0, 1.0), (50.4, 1.0), (50.6, None), (400, None)])
def test_threshold_is_on_rounded_metres(spark, dim, metres, snapped):
    row = repair_candidates(bad_rows(flag(bronze(spark, lost_start(metres)))), dim).first()
    assert row.start_stn_id_repaired == snapped
    assert row.start_snap_m == round(metres)
    assert row.start_stn_imputed is (snapped is not None)
    assert (row.end_stn_id_repaired, row.end_stn_imputed, row.end_snap_m) == (2.0, False, None)


def test_only_rows_that_lack_a_station_and_have_key_and_place(spark, dim):
    df = bronze(
        spark,
        lost_start(1),
        lost_start(1, ride_id=None),
        lost_start(1, ride_id=" "),
        {"start_station_id": None, "start_lat": None},
        {"ended_at": "2024-02-01 00:00:00"},
    )
    assert ids(repair_candidates(bad_rows(flag(df)), dim)) == [" ", "R0"]


def test_rows_with_one_key_do_not_multiply(spark, dim):
    df = bronze(spark, lost_start(1, ride_id="D"), lost_start(2, ride_id="D"))
    found = repair_candidates(bad_rows(flag(df)), dim)
    assert sorted(cells(found, "ride_id", "start_snap_m")) == [("D", 1), ("D", 2)]


def test_one_side(spark, dim):
    bad = bad_rows(flag(bronze(spark, lost_start(3), {"end_lat": None})))
    found = snap_to_nearest(bad, dim, SIDES[0])
    assert sorted(cells(found, "ride_id", "start_near_stn", "start_snap_m"), key=str) == [
        ("R0", 1, 3),
        ("R1", None, None),
    ]


def test_merge_takes_only_rows_without_other_failures(spark):
    df = bronze(
        spark,
        {},
        lost_start(5, ride_id="near"),
        lost_start(200, ride_id="far"),
        lost_start(5, ride_id="long", ended_at="2024-01-12 08:00:00"),
        lost_start(5, ride_id="both", end_station_id=None, end_station_name=None),
        lost_start(5, ride_id="half", end_station_id=None, end_station_name=None, end_lat=38.95),
    )
    flagged = flag(df)
    silver = to_silver(flagged)
    dim = role_union_dim(silver)
    candidates = repair_candidates(bad_rows(flagged), dim)
    assert ids(candidates) == ["both", "far", "half", "long", "near"]
    assert ids(recovered(candidates)) == ["both", "near"]
    merged = merge_repaired(silver, candidates, dim)
    rows = {r.ride_id: r for r in merged.collect()}
    assert sorted(rows) == ["R0", "both", "near"]
    assert (rows["near"].start_stn_id, rows["near"].start_stn_name) == (1, "A")
    assert (rows["near"].start_stn_imputed, rows["near"].end_stn_imputed) == (True, False)
    assert (rows["both"].end_stn_id, rows["both"].end_stn_name) == (2, "B")
    assert (rows["R0"].start_stn_imputed, rows["R0"].end_stn_imputed) == (False, False)
    summary = recovery_summary(flagged, candidates).first()
    assert (summary.total, summary.quarantined, summary.recovered, summary.unusable) == (6, 5, 2, 3)
    assert summary.recovered_pct == 40.0
