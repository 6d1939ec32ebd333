"""Loads that survive malformed records."""

import pytest

from ridestrata.plans.monthly import run_months
from ridestrata.sources import warehouse as wh
from ridestrata.sources.archive import month_folder, read_readable_csv, read_readable_months
from ridestrata.schemas import TRIPS
from tests.test_sources import HEADER, csv_text, land, line
from tests.test_warehouse import layers  # noqa: F401
from tests.trips import cells, ids

SHORT, LONG = ",".join(line(ride_id="s").split(",")[:-2]), line(ride_id="l") + ",x,y"
BAD = [SHORT, LONG, line(ride_id="n", start_lat="north", end_station_id="1O"), line(ride_id="t", ended_at="soon"), line(ride_id="b", started_at="?", end_lng="-")]
GOOD = [line(ride_id="a"), line(ride_id="m", start_lat="NaN", started_at="N/A"), line(ride_id='"q, r"', end_station_name=None)]
REASONS = {
    SHORT: ["fields"], LONG: ["fields"], BAD[2]: ["number_end_station_id", "number_start_lat"],
    BAD[3]: ["time_ended_at"], BAD[4]: ["number_end_lng", "time_started_at"],
}


def judged(unreadable):
    return {r["record"]: sorted(r["reasons"]) for r in unreadable.collect()}


def test_csv_with_malformed_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text(csv_text(GOOD[0], *BAD, *GOOD[1:]))
    rows, unreadable = read_readable_csv(spark, [str(tmp_path)])
    assert ids(rows) == ["a", "m", "q, r"] and rows.schema.names == TRIPS.names
    assert cells(rows.where("ride_id = 'm'"), "start_lat", "started_at") == [(None, None)]
    assert unreadable.columns == ["record", "reasons"] and judged(unreadable) == REASONS


@pytest.mark.parametrize("zipped", [True, False])
def test_months_with_malformed_records(spark, layers, tmp_path, zipped):  # noqa: F811
    land(tmp_path, 2024, 1, csv_text(*GOOD[:1], *BAD), zipped)
    land(tmp_path, 2024, 2, csv_text(line(ride_id="z")), zipped)
    folders = [month_folder(str(tmp_path), 2024, m) for m in (1, 2)]
    rows, unreadable = read_readable_months(spark, folders, zipped)
    assert sorted(cells(rows, "ride_id", "month")) == [("a", 1), ("z", 2)]
    assert judged(unreadable) == REASONS and {(r["year"], r["month"]) for r in unreadable.collect()} == {(2024, 1)}
    with pytest.raises(Exception):
        run_months(spark, str(tmp_path), [(2024, 1)], zipped, tested=False)
    run_months(spark, str(tmp_path), [(2024, 1)], zipped, tested=False, keep_unreadable=True)
    assert ids(wh.read_model(spark, "silver", "trips")) == ["a"]
    assert wh.read_model(spark, "bronze", "unreadable").count() == len(BAD)
    land(tmp_path, 2024, 1, csv_text(*GOOD[:1]), zipped)
    run_months(spark, str(tmp_path), [(2024, 1)], zipped, True, tested=False, keep_unreadable=True)
    assert wh.read_model(spark, "bronze", "unreadable").isEmpty()


@pytest.mark.parametrize("zipped", [True, False])
def test_other_headers_are_still_errors(spark, tmp_path, zipped):
    land(tmp_path, 2024, 1, csv_text(line(), header=HEADER.replace("ride_id", "trip")), zipped)
    with pytest.raises(Exception):
        read_readable_months(spark, [month_folder(str(tmp_path), 2024, 1)], zipped)[0].collect()
