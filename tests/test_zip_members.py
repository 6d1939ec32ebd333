import zipfile

import pytest

from ridestrata.sources.archive import RECORD, read_trip_archives, zip_text
from tests.test_sources import csv_text, land, line
from tests.trips import cells, ids


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_each_member_is_a_partition(spark, tmp_path, scheme):
    folder = tmp_path / "2024" / "01"
    folder.mkdir(parents=True)
    for name, members in (("a", "pq"), ("b", "r")):
        with zipfile.ZipFile(folder / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for member in members:
                archive.writestr(f"in/{member}.csv", csv_text(line(ride_id=member)))
    (folder / "note.txt").write_text("no zip")
    text = zip_text(spark, [f"{scheme}{folder}/"])
    assert text.rdd.getNumPartitions() == 3
    assert ids(text) == ["p", "q", "r"]
    assert cells(read_trip_archives(spark, [f"{scheme}{folder}"]), "year", "month") == [(2024, 1)] * 3


def test_streamed_and_whole_zips_agree(spark, tmp_path):
    rows = [line(ride_id=f"r{i}", start_station_name='"K, St\nNW"') for i in range(30_000)]
    land(tmp_path, 2024, 1, csv_text(*rows))
    land(tmp_path, 2024, 2, csv_text(line(ride_id="x", end_lat="NA")))
    folders = [f"{tmp_path}/2024/01", f"{tmp_path}/2024/02"]
    streamed, whole = (read_trip_archives(spark, folders, streamed=way) for way in (True, False))
    assert streamed.schema == whole.schema
    assert streamed.count() == 30_001
    assert streamed.exceptAll(whole).count() == whole.exceptAll(streamed).count() == 0


def test_records_that_cannot_be_read_are_kept_or_fail(spark, tmp_path):
    land(tmp_path, 2024, 1, csv_text(line(ride_id="a"), "short,record", line(ride_id="b")))
    folder = [f"{tmp_path}/2024/01"]
    kept = zip_text(spark, folder, keep_unreadable=True)
    assert cells(kept.where(f"{RECORD} is not null"), RECORD) == [("short,record",)]
    assert ids(kept.where(f"{RECORD} is null")) == ["a", "b"]
    with pytest.raises(Exception):
        zip_text(spark, folder).collect()


def test_a_folder_without_zips_has_no_rows(spark, tmp_path):
    assert zip_text(spark, [str(tmp_path)]).count() == 0
