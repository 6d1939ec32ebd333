import zipfile

import pytest
from pyspark.sql import functions as F

from ridestrata.schemas import TRIPS
from ridestrata.sources.archive import (
    MISSING_TEXTS,
    archive_name,
    month_folder,
    month_key,
    read_trip_archives,
    read_trip_csv,
    read_trip_csv_months,
)
from ridestrata.streaming.replay import replay_new_files
from tests.trips import GOOD, cells, ids

HEADER = ",".join(TRIPS.names)


def line(**changes):
    trip = {**GOOD, **changes}
    return ",".join("" if trip[name] is None else str(trip[name]) for name in TRIPS.names)


def csv_text(*lines, header=HEADER):
    return "\n".join([header, *lines]) + "\n"


def land(root, year, month, text, zipped=True, name="202401-trips"):
    folder = root / str(year) / f"{month:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    if zipped:
        with zipfile.ZipFile(folder / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{name}.csv", text)
            archive.writestr(f"__MACOSX/._{name}.csv", "junk")
            archive.writestr("readme.txt", "junk")
    else:
        (folder / f"{name}.csv").write_text(text)


def test_month_addressing():
    assert month_key(2024, 3) == month_key("2024", "3") == month_key("2024", "03") == "202403"
    assert month_folder("/archive/", 2024, 11) == "/archive/2024/11"
    assert archive_name("2024", "1", "trips") == "202401-trips.zip"


@pytest.mark.parametrize("zipped", [True, False])
def test_months_are_read_by_folder(spark, tmp_path, zipped):
    land(tmp_path, 2024, 1, csv_text(line(ride_id="a"), line(ride_id="b")), zipped)
    land(tmp_path, 2024, 2, csv_text(line(ride_id="c")), zipped)
    land(tmp_path, 2024, 3, csv_text(line(ride_id="d")), zipped)
    read = read_trip_archives if zipped else read_trip_csv_months
    trips = read(spark, [month_folder(str(tmp_path), 2024, m) for m in (1, 3)])
    assert sorted(cells(trips, "ride_id", "year", "month")) == [
        ("a", 2024, 1),
        ("b", 2024, 1),
        ("d", 2024, 3),
    ]
    assert trips.select(*TRIPS.names).schema == TRIPS


@pytest.mark.parametrize("zipped", [True, False])
def test_quotes_empty_and_missing_texts(spark, tmp_path, zipped):
    lines = [
        line(ride_id="q", start_station_name='"5th, and ""K"" St"', start_station_id=None),
        line(ride_id="n", start_station_name="NA", start_station_id="nan", end_lat="null"),
        line(ride_id="s", start_station_name="  ", member_casual="NAN"),
    ]
    land(tmp_path, 2024, 1, csv_text(*lines), zipped)
    read = read_trip_archives if zipped else read_trip_csv_months
    rows = {r.ride_id: r for r in read(spark, [f"{tmp_path}/2024/01"]).collect()}
    assert rows["q"].start_station_name == '5th, and "K" St'
    assert rows["q"].start_station_id is None and rows["q"].end_station_id == 2.0
    assert (rows["n"].start_station_name, rows["n"].start_station_id, rows["n"].end_lat) == (None,) * 3
    assert rows["s"].start_station_name == "  " and rows["s"].member_casual == "NAN"
    assert "NA" in MISSING_TEXTS and "NAN" not in MISSING_TEXTS


@pytest.mark.parametrize("zipped", [True, False])
def test_line_break_in_a_quoted_value(spark, tmp_path, zipped):
    land(tmp_path, 2024, 1, csv_text(line(start_station_name='"K St\nNW"')), zipped)
    folder = [f"{tmp_path}/2024/01"]
    trips = read_trip_archives(spark, folder) if zipped else read_trip_csv_months(spark, folder, True)
    assert cells(trips, "start_station_name", "month") == [("K St\nNW", 1)]


def test_columns_of_a_zip_go_by_name(spark, tmp_path):
    turned = list(reversed(TRIPS.names))
    text = ",".join(turned) + "\n" + ",".join(str(GOOD[name]) for name in turned) + "\n"
    land(tmp_path, 2024, 1, text)
    assert cells(read_trip_archives(spark, [f"{tmp_path}/2024/01"]), *TRIPS.names) == [
        tuple(GOOD[name] for name in TRIPS.names)
    ]


def test_large_zip_arrives_in_blocks(spark, tmp_path):
    rows = [line(ride_id=f"r{i}") for i in range(60_000)]
    land(tmp_path, 2024, 1, csv_text(*rows))
    trips = read_trip_archives(spark, [f"{tmp_path}/2024/01"])
    assert trips.count() == 60_000 and trips.select("ride_id").distinct().count() == 60_000


@pytest.mark.parametrize(
    "text",
    [
        csv_text(line(), header=",".join(reversed(TRIPS.names))),
        csv_text(line() + ",extra"),
        csv_text(line(start_lat="north")),
    ],
)
def test_unexpected_csv_fails_loudly(spark, tmp_path, text):
    land(tmp_path, 2024, 1, text, zipped=False)
    with pytest.raises(Exception):
        read_trip_csv(spark, [f"{tmp_path}/2024/01"]).collect()


def test_replay_loads_each_file_once(spark, tmp_path):
    root, table, progress = (tmp_path / n for n in ("raw", "table", "progress"))
    land(root, 2024, 1, csv_text(line(ride_id="a"), line(ride_id="b")), zipped=False)
    for _ in range(2):
        replay_new_files(spark, str(root), str(table), str(progress)).awaitTermination(120)
    land(root, 2024, 2, csv_text(line(ride_id="c")), zipped=False)
    replay_new_files(spark, str(root), str(table), str(progress)).awaitTermination(120)
    loaded = spark.read.parquet(str(table))
    assert ids(loaded) == ["a", "b", "c"]
    assert loaded.where(F.col("month") == 2).count() == 1


def test_zip_without_csv_and_extra_column_fail(spark, tmp_path):
    land(tmp_path, 2024, 1, csv_text(line() + ",1", header=HEADER + ",more"))
    with pytest.raises(Exception, match="has columns"):
        read_trip_archives(spark, [month_folder(str(tmp_path), 2024, 1)]).collect()
    folder = tmp_path / "2024" / "02"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as archive:
        archive.writestr("readme.txt", "junk")
    with pytest.raises(Exception, match="no CSV file"):
        read_trip_archives(spark, [month_folder(str(tmp_path), 2024, 2)]).collect()
