from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ridestrata.functions.scalars import blank, labelled, rounded, share_percent, two_digits, whole_number
from ridestrata.operators.datatests import DataTestsFailed
from ridestrata.plans import ridership
from ridestrata.plans.monthly import (
    build_calendar,
    ingest,
    rule_failures,
    run_month,
    run_months,
    store_repaired,
)
from ridestrata.schemas import HOLIDAYS, TRIPS
from ridestrata.sources import warehouse as wh
from tests.test_sources import csv_text, land, line
from tests.trips import cells, ids


@pytest.fixture()
def layers(spark):
    wh.create_layers(spark)
    wh.create_layers(spark)
    yield
    for layer in wh.LAYERS:
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_table_name():
    assert wh.table_name(" gold ", "dim_date") == "gold.dim_date"
    for layer in (None, "", "  "):
        with pytest.raises(ValueError):
            wh.table_name(layer, "x")


def test_replace_and_create_only(spark, layers):
    wh.replace_table(spark.range(3), "silver", "t")
    wh.replace_table(spark.range(5), "silver", "t")
    assert wh.read_model(spark, "silver", "t").count() == 5
    wh.create_table(spark.range(2), "gold", "dim_weather")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        wh.create_table(spark.range(2), "gold", "dim_weather")


def test_create_only_folder(spark, tmp_path):
    assert wh.create_folder(spark.range(2), f"{tmp_path}/t").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        wh.create_folder(spark.range(2), f"{tmp_path}/t")


def test_months_are_replaced_alone(spark, layers):
    def load(rows):
        return wh.replace_months(spark.createDataFrame(rows, "v string, year int, month int"), "bronze", "m")

    load([("old", 2024, 1), ("keep", 2024, 2)])
    load([("new", 2024, 1)])
    again = load([("new", 2024, 1)])
    assert sorted(cells(again, "v", "month")) == [("keep", 2), ("new", 1)]


def test_sql_with_parameters_and_files(spark, tmp_path):
    wh.publish_view(spark.range(10), "numbers")
    text = "SELECT count(*) AS n FROM numbers WHERE (:low IS NULL OR id >= :low)"
    assert wh.run_sql(spark, text, low=7).first().n == 3
    assert wh.run_sql(spark, text, low=None).first().n == 10
    file = tmp_path / "s.sql"
    file.write_text("CREATE OR REPLACE TEMPORARY VIEW v AS SELECT ';' AS s FROM numbers;\n\nSELECT count(*) AS n FROM v;")
    assert wh.run_sql_file(spark, str(file)).first().n == 10


def test_scalars(spark):
    row = spark.createDataFrame([(2.5, -2.5, 38.123455, 3, "  ", "\t", "US", "XX")], "a double, b double, c double, m int, s string, t string, k string, u string").select(
        whole_number(F.lit(3.7)).alias("w"),
        rounded(F.col("a"), 0).cast("int").alias("up"),
        rounded(F.col("b"), 0).cast("int").alias("down"),
        rounded(F.col("c"), 5).cast("string").alias("five"),
        two_digits(F.col("m")).alias("mm"),
        blank(F.col("s")).alias("blank"),
        blank(F.col("t")).alias("tab"),
        labelled(F.col("k"), {"US": "United States"}).alias("known"),
        labelled(F.col("u"), {"US": "United States"}).alias("unknown"),
        share_percent(F.lit(1), F.lit(8)).alias("share"),
        share_percent(F.lit(0), F.lit(0)).alias("nothing"),
    ).first()
    assert tuple(row) == (4, 3, -3, "38.12346", "03", True, False, "United States", "XX", 13.0, 0.0)


def january(**more):
    return [
        line(ride_id="a", **more),
        line(ride_id="b", started_at="2024-01-15 22:30:00", ended_at="2024-01-15 22:40:00", member_casual="casual", **more),
        line(ride_id="c", start_station_id=None, start_station_name=None),
        line(ride_id="d", start_station_id=2.0, start_station_name="B", end_station_id=1.0, end_station_name="A"),
    ]


@pytest.mark.parametrize("zipped", [True, False])
def test_month_run(spark, layers, tmp_path, zipped):
    land(tmp_path, 2024, 1, csv_text(*january()), zipped)
    built = run_month(spark, str(tmp_path), 2024, 1, zipped=zipped)
    assert ids(wh.read_model(spark, "silver", "trips")) == ["a", "b", "d"]
    assert ids(wh.read_model(spark, "bronze", "quarantine")) == ["c"]
    assert ids(rule_failures(spark, "missing_start_station_id")) == ["c"]
    assert rule_failures(spark, "negative_duration").isEmpty()
    assert sorted(cells(built.stations, "stn_id", "stn_name")) == [(1, "A"), (2, "B")]
    assert cells(wh.read_model(spark, "silver", "temp"), "ride_id", "start_stn_id_repaired") == [("c", 1.0)]
    assert ids(store_repaired(spark)) == ["a", "b", "c", "d"]
    in_gold = wh.read_model(spark, "gold", "fct_trips_repaired").where("start_stn_imputed")
    assert cells(in_gold, "ride_id", "start_stn_id", "end_stn_imputed") == [("c", 1, False)]
    assert wh.read_model(spark, "gold", "dim_stations_repaired").count() == 2
    holidays = spark.createDataFrame([("US", date(2024, 1, 15), "MLK Day")], HOLIDAYS)
    dates = build_calendar(spark, holidays)
    days = ridership.daily(wh.read_model(spark, "gold", "fct_trips"), dates)
    assert [(r.day, r.trips, r.is_holiday, r.long_weekend) for r in days.collect()] == [
        (date(2024, 1, 10), 2, 0, 0),
        (date(2024, 1, 15), 1, 1, 1),
    ]


def test_failed_data_tests_stop_the_run(spark, layers, tmp_path):
    land(tmp_path, 2024, 1, csv_text(*january(rideable_type="scooter")))
    with pytest.raises(DataTestsFailed, match="accepted_rideable_type"):
        run_month(spark, str(tmp_path), 2024, 1)
    assert run_month(spark, str(tmp_path), 2024, 1, tested=False).silver.count() == 3


def test_backfill_is_repeatable(spark, layers, tmp_path):
    land(tmp_path, 2023, 12, csv_text(line(ride_id="x", started_at="2023-12-31 23:50:00", ended_at="2024-01-01 00:10:00")))
    land(tmp_path, 2024, 1, csv_text(*january()))
    months = [(2023, 12), (2024, 1)]
    for _ in range(2):
        built = run_months(spark, str(tmp_path), months, tested=False)
        assert ids(built.silver) == ["a", "b", "d", "x"]
    land(tmp_path, 2024, 1, csv_text(line(ride_id="z")))
    again = ingest(spark, str(tmp_path), [(2024, 1)], keep_other_months=True)
    assert ids(again) == ["x", "z"]
    assert ids(ingest(spark, str(tmp_path), [(2024, 1)])) == ["z"]


def test_bounds_prune_the_stored_fact(spark, layers, capsys):
    trips = spark.createDataFrame(
        [
            ("a", "t", datetime(2024, 1, 10, 12), datetime(2024, 1, 10, 13), 1, 2, "member"),
            ("b", "t", datetime(2024, 2, 1, 4, 59), datetime(2024, 2, 1, 5), 1, 2, "member"),
            ("c", "t", datetime(2024, 2, 1, 5, 0), datetime(2024, 2, 1, 6), 1, 2, "casual"),
        ],
        "ride_id string, rideable_type string, start_time timestamp, end_time timestamp, start_stn_id int, end_stn_id int, rider_type string",
    )
    stored = wh.replace_table(ridership.with_month_column(trips), "gold", "fct_trips", (ridership.MONTH_COLUMN,))
    january = ridership.scoped(stored, date(2024, 1, 1), date(2024, 1, 31))
    assert ids(january) == ["a", "b"]
    ridership.kpis(stored, date(2024, 1, 1), date(2024, 1, 31)).explain("formatted")
    plan = capsys.readouterr().out
    assert "(start_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(start_time,2024-01-01 05:00:00.0)" in plan
    assert "LessThan(start_time,2024-02-01 05:00:00.0)" in plan
    assert "ride_id" not in plan.split("ReadSchema")[1]


def test_an_empty_month_replaces_nothing(spark, layers, tmp_path):
    land(tmp_path, 2024, 1, csv_text(line()))
    ingest(spark, str(tmp_path), [(2024, 1)])
    (tmp_path / "2024" / "02").mkdir()
    for keep in (False, True):
        with pytest.raises(FileNotFoundError, match="2024/02"):
            ingest(spark, str(tmp_path), [(2024, 1), (2024, 2)], keep_other_months=keep)
    assert wh.read_model(spark, "bronze", "trips").count() == 1


def test_sql_file_with_other_line_ends(spark, tmp_path):
    file = tmp_path / "two.sql"
    file.write_bytes(b"SELECT 1 AS a;  \r\nSELECT 2 AS a;\r\n")
    assert wh.run_sql_file(spark, str(file)).first()["a"] == 2
