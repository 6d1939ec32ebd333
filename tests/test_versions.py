"""Tables of versions, and months that are loaded one by one."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ridestrata.operators.conform import role_union_dim, to_silver
from ridestrata.operators.quarantine import bad_rows, flag
from ridestrata.operators.repair import repair_candidates
from ridestrata.plans.monthly import MONTH, run_months
from ridestrata.sources import warehouse as wh
from ridestrata.sources.versions import current_version, publish, stage
from tests.test_sources import csv_text, land, line
from tests.test_warehouse import layers  # noqa: F401
from tests.trips import cells, ids


def rows(df, *without):
    return Counter(str(row) for row in df.drop(*without).select(sorted(set(df.columns) - set(without))).collect())


def test_a_failing_write_keeps_the_old_rows(spark, layers):  # noqa: F811
    wh.replace_table(spark.range(3).withColumn("p", F.col("id") % 2), "silver", "t", ("p",))
    broken = spark.range(10).withColumn("p", F.expr("if(id = 9, raise_error('no'), id % 2)").cast("long"))
    for write in (lambda: wh.replace_table(broken, "silver", "t", ("p",)), lambda: stage(broken, "silver", "t", ("p",))):
        with pytest.raises(Exception, match="no"):
            write()
        assert ids(wh.read_model(spark, "silver", "t"), "id") == ["0", "1", "2"]
    wh.replace_table(spark.range(4).withColumn("p", F.lit(0)), "silver", "t", ("p",))
    assert wh.read_model(spark, "silver", "t").count() == 4


def test_rebuild_from_itself_readers_and_old_versions(spark, layers):  # noqa: F811
    wh.replace_table(spark.range(3), "silver", "t")
    reader = wh.read_model(spark, "silver", "t")
    files = reader.inputFiles()
    for n in (2, 4, 8):
        again = wh.replace_table(wh.read_model(spark, "silver", "t").selectExpr(f"id * {n} AS id", "'x' AS added"), "silver", "t")
        if n == 2:
            assert ids(reader, "id") == ["0", "1", "2"]
    assert ids(again, "id") == ["0", "128", "64"] and again.columns == ["id", "added"]
    with pytest.raises(Exception):
        spark.read.parquet(*files).count()
    versions = spark.sql("SHOW TABLES IN silver LIKE 't__v*'").count()
    assert versions == 2
    staged = stage(spark.range(1), "silver", "t")
    assert again.count() == 3 and staged.rows().count() == 1
    publish(staged)
    assert wh.read_model(spark, "silver", "t").count() == 1


def test_partitions_that_are_not_stale_keep_their_files(spark, layers):  # noqa: F811
    def load(values, months=None):
        df = spark.createDataFrame(values, "v string, rule string, year int, month int")
        return wh.replace_months(df, "audit", "m", ("rule", "year", "month"), months)

    load([("a", "it's /=%", 2024, 1), ("b", None, 2024, 2), ("c", "\\x", 2024, 3)])
    before = set(wh.read_model(spark, "audit", "m").inputFiles())
    again = load([("d", "new", 2024, 1)])
    assert sorted(cells(again, "v", "rule"), key=str) == [("b", None), ("c", "\\x"), ("d", "new")]
    assert len(before & set(again.inputFiles())) == 2
    gone = load([], [(2024, 2)])
    assert sorted(cells(gone, "v", "month")) == [("c", 3), ("d", 1)]
    assert load([], [(2024, 1), (2024, 3)]).count() == 0
    assert cells(load([("z", None, 2023, 12)]), "v", "rule", "year", "month") == [("z", None, 2023, 12)]


def test_plain_tables_are_not_replaced(spark, layers):  # noqa: F811
    wh.create_table(spark.range(2), "gold", "dim_weather")
    assert current_version(spark, "gold", "dim_weather") is None
    with pytest.raises(ValueError, match="dim_weather"):
        wh.replace_table(spark.range(3), "gold", "dim_weather")
    assert wh.read_model(spark, "gold", "dim_weather").count() == 2


def equals_full_build(spark, strict=True):
    flagged = flag(wh.read_model(spark, "bronze", "trips")).cache()
    silver = to_silver(flagged, strict=strict)
    stations = role_union_dim(silver)
    assert rows(wh.read_model(spark, "silver", "trips"), *MONTH) == rows(silver)
    assert rows(wh.read_model(spark, "bronze", "quarantine")) == rows(bad_rows(flagged))
    assert rows(wh.read_model(spark, "gold", "dim_stations")) == rows(stations)
    assert rows(wh.read_model(spark, "silver", "temp")) == rows(repair_candidates(bad_rows(flagged), stations))
    facts = wh.read_model(spark, "gold", "fct_trips")
    assert rows(facts.select("ride_id", "start_stn_id", "start_time")) == rows(silver.select("ride_id", "start_stn_id", "start_time"))
    assert wh.read_model(spark, "audit", "failures").count() == sum(len(r["failed_rules"]) for r in bad_rows(flagged).collect())


def test_what_a_new_month_touches(spark, layers, tmp_path):  # noqa: F811
    def load(month, *trips):
        land(tmp_path, 2024, month, csv_text(*trips), False)
        return run_months(spark, str(tmp_path), [(2024, month)], zipped=False, keep_other_months=True, tested=False).touched

    def files(layer, model, month):
        return set(wh.read_model(spark, layer, model).where(f"month = {month}").select("_metadata.file_path").distinct().toPandas()["file_path"]) if layer == "bronze" else {
            f for f in wh.read_model(spark, layer, model).inputFiles() if f"month={month}/" in f
        }

    other = {"start_station_id": 5.0, "start_station_name": "E", "end_station_id": 6.0, "end_station_name": "F"}
    assert load(1, line(ride_id="a"), line(ride_id="b", **other)) == {(2024, 1)}
    assert load(3, line(ride_id="c", **other)) == {(2024, 3)}
    kept = files("silver", "trips", 3), files("gold", "fct_trips", 3)
    # Station 1 gets a second name: January is flagged again, March keeps its files.
    assert load(2, line(ride_id="d", start_station_name="A2")) == {(2024, 1), (2024, 2)}
    assert ids(wh.read_model(spark, "silver", "trips")) == ["b", "c"]
    assert kept == (files("silver", "trips", 3), files("gold", "fct_trips", 3)) and all(kept)
    equals_full_build(spark)
    # The second name is gone again, and no row is left of February.
    assert load(2, line(ride_id="d", rideable_type=None)) == {(2024, 1), (2024, 2)}
    assert ids(wh.read_model(spark, "silver", "trips")) == ["a", "b", "c"]
    equals_full_build(spark)
    # A bad copy of a ride of March: its silver changes, January keeps its files.
    kept = files("silver", "trips", 1)
    assert load(4, line(ride_id="c", member_casual=None, **other), line(ride_id="x", **other)) == {(2024, 3), (2024, 4)}
    assert ids(wh.read_model(spark, "silver", "trips")) == ["a", "b", "x"]
    assert kept == files("silver", "trips", 1)
    equals_full_build(spark)
    assert load(4, line(ride_id="x", **other)) == {(2024, 3), (2024, 4)}
    assert ids(wh.read_model(spark, "silver", "trips")) == ["a", "b", "c", "x"]
    equals_full_build(spark)


@pytest.mark.parametrize("strict", [True, False])
def test_months_one_by_one_equal_a_full_build(spark, layers, tmp_path, strict):  # noqa: F811
    rng = random.Random(7 + strict)

    def trip():
        station = rng.choice([1.0, 2.0, 3.0, None])
        return line(
            ride_id=rng.choice([f"r{rng.randrange(30)}", None]) if rng.random() < 0.9 else "  ",
            start_station_id=station,
            start_station_name=None if station is None else rng.choice([f"S{station}"] * 12 + ["other"]),
            start_lat=38.9 + rng.randrange(4) / 10_000,
            member_casual=rng.choice(["member", "casual", "member", None]),
        )

    for step in range(4):
        month = rng.randrange(1, 5)
        land(tmp_path, 2024, month, csv_text(*[trip() for _ in range(rng.randrange(1, 12))]), False)
        run_months(spark, str(tmp_path), [(2024, month)], zipped=False, keep_other_months=True, strict=strict, tested=False)
    equals_full_build(spark, strict)


def test_a_run_that_dies_can_be_run_again(spark, layers, tmp_path, monkeypatch):  # noqa: F811
    from ridestrata.plans import monthly

    land(tmp_path, 2024, 1, csv_text(line(ride_id="a")), False)
    run_months(spark, str(tmp_path), [(2024, 1)], zipped=False, keep_other_months=True, tested=False)
    land(tmp_path, 2024, 2, csv_text(line(ride_id="b", start_station_name="A2"), line(ride_id="a", rideable_type=None)), False)
    whole = monthly.publish
    for done in (0, 3):

        def dies(*staged, done=done):
            whole(*staged[:done])
            raise RuntimeError("lost")

        monkeypatch.setattr(monthly, "publish", dies)
        with pytest.raises(RuntimeError):
            run_months(spark, str(tmp_path), [(2024, 2)], zipped=False, keep_other_months=True, tested=False)
        if not done:
            assert ids(wh.read_model(spark, "silver", "trips")) == ["a"]
    monkeypatch.setattr(monthly, "publish", whole)
    run_months(spark, str(tmp_path), [(2024, 2)], zipped=False, keep_other_months=True, tested=False)
    equals_full_build(spark)
