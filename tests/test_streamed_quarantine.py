"""The quarantine of files that arrive one after the other is that of one load."""

import pytest
from pyspark.sql import functions as F

from ridestrata.operators.quarantine import flag
from ridestrata.sources.archive import read_trip_csv_months
from ridestrata.streaming.quarantine import append_checked, flagged_so_far, load_new_files
from tests.test_sources import csv_text, land, line

COLUMNS = ["ride_id", "start_station_id", "start_station_name", "end_station_name", "month", "is_bad", "failed_rules"]


def rows(flagged):
    return sorted(map(str, flagged.select(*COLUMNS).collect()))


def one_load(spark, root, months, **options):
    folders = [f"{root}/2024/{month:02d}" for month in months]
    return rows(flag(read_trip_csv_months(spark, folders), **options))


@pytest.fixture
def folders(tmp_path):
    return tmp_path / "raw", str(tmp_path / "streamed")


def test_late_name_reaches_rows_of_earlier_batches(spark, folders):
    root, streamed = folders
    land(root, 2024, 1, csv_text(line(ride_id="a"), line(ride_id="b", start_station_id=7.0), line(ride_id="")), zipped=False)
    first = load_new_files(spark, str(root), streamed)
    assert rows(first) == one_load(spark, root, [1])
    assert first.where("is_bad").count() == 1
    # Months come out of order, with an id that drifts only between batches.
    land(root, 2024, 3, csv_text(line(ride_id="c", start_station_name="Z"), line(ride_id="a")), zipped=False)
    second = load_new_files(spark, str(root), streamed)
    assert rows(second) == one_load(spark, root, [1, 3])
    assert [r[0] for r in second.where("ride_id = 'a' and month = 1").select("failed_rules").collect()] == [["start_name_drift"]]
    land(root, 2024, 2, csv_text(line(ride_id="d", end_lat=None, end_station_name="Y")), zipped=False)
    third = load_new_files(spark, str(root), streamed)
    assert rows(third) == one_load(spark, root, [1, 2, 3])
    assert [r[0] for r in third.where("ride_id = 'd'").select("failed_rules").collect()] == [["missing_end_lat", "start_name_drift", "end_name_drift"]]


def test_files_are_loaded_once_and_a_dead_call_is_made_good(spark, folders):
    root, streamed = folders
    land(root, 2024, 1, csv_text(line(ride_id="a"), line(ride_id="a")), zipped=False)
    for _ in range(2):
        flagged = load_new_files(spark, str(root), streamed)
        assert flagged.count() == 2
    land(root, 2024, 1, csv_text(line(ride_id="b", start_station_name="Z")), zipped=False, name="202401-more")
    append_checked(spark, str(root), streamed)  # the call ends here, the names are not read
    assert flagged_so_far(spark, streamed).where("is_bad").count() == 0
    assert rows(load_new_files(spark, str(root), streamed)) == one_load(spark, root, [1])
    names = spark.read.parquet(f"{streamed}/names")
    assert names.count() == names.distinct().count() == 3


def test_one_file_per_batch_and_names_across_roles(spark, folders):
    root, streamed = folders
    for number, name in enumerate(["A", "B", "A", "C"]):
        text = csv_text(line(ride_id=f"r{number}", start_station_id=2.0, start_station_name=name))
        land(root, 2024, 1, text, zipped=False, name=f"part-{number}")
    flagged = load_new_files(spark, str(root), streamed, across_roles=True, files_per_batch=1)
    assert rows(flagged) == one_load(spark, root, [1], across_roles=True)
    assert flagged.where(F.array_contains("failed_rules", "end_name_drift")).count() == 4


def test_no_drift_checks_and_no_rows(spark, folders):
    root, streamed = folders
    land(root, 2024, 1, csv_text(), zipped=False)
    assert load_new_files(spark, str(root), streamed).count() == 0
    land(root, 2024, 2, csv_text(line(ride_id="a"), line(ride_id="b", end_lng=None)), zipped=False)
    assert rows(load_new_files(spark, str(root), streamed, drift=())) == one_load(spark, root, [1, 2], drift=())
