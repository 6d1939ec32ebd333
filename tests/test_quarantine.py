import pytest
from pyspark.sql import functions as F

from ridestrata.operators.conform import to_silver
from ridestrata.operators.quarantine import (
    bad_rows,
    excluding_keys,
    failure_counts,
    failures_by_rule,
    failures_long,
    flag,
    quarantine,
    quarantine_ratio_alarm,
    without_quarantined,
)
from ridestrata.operators.rules import TRIP_DRIFT, TRIP_TEXT, TRIP_VALUES, Rule, ride_length, trip_rules
from ridestrata.sources.archive import with_month
from tests.trips import bronze, cells, ids


def failed(df, **options):
    return {row.ride_id: row.failed_rules for row in flag(df, **options).collect()}


@pytest.mark.parametrize("column", [c for c in TRIP_TEXT if c != "ride_id"])
@pytest.mark.parametrize("value, is_missing", [(None, True), ("", True), ("  ", True), ("\t", False)])
def test_required_text(spark, column, value, is_missing):
    found = failed(bronze(spark, {column: value}), drift=())
    assert found["R0"] == ([f"missing_{column}"] if is_missing else [])


@pytest.mark.parametrize("column", TRIP_VALUES)
def test_required_value(spark, column):
    assert failed(bronze(spark, {column: None}), drift=())["R0"] == [f"missing_{column}"]


@pytest.mark.parametrize(
    "end, rules",
    [
        ("2024-01-10 07:59:59.999999", ["negative_duration"]),
        ("2024-01-10 08:00:00", []),
        ("2024-01-10 16:20:00", []),
        ("2024-01-10 16:20:00.000001", ["over_long_duration"]),
    ],
)
def test_duration_bounds(spark, end, rules):
    assert failed(bronze(spark, {"ended_at": end}))["R0"] == rules


def test_duration_over_the_end_of_summer_time(spark):
    ride = {"started_at": "2023-11-05 01:50:00", "ended_at": "2023-11-05 01:10:00"}
    assert failed(bronze(spark, ride))["R0"] == ["negative_duration"]
    before = {"started_at": "2023-11-05 00:50:00", "ended_at": "2023-11-05 09:15:00"}
    assert failed(bronze(spark, before))["R0"] == ["over_long_duration"]
    rows = bronze(spark, {"started_at": "2023-11-05 00:50:00", "ended_at": "2023-11-05 08:15:00"})
    assert failed(rows)["R0"] == []
    assert failed(rows, rules=trip_rules(basis="instant"))["R0"] == ["over_long_duration"]


def test_unknown_duration_basis(spark):
    with pytest.raises(ValueError):
        ride_length(basis="moon")


def test_drift_ignores_null_names_and_null_ids(spark):
    df = bronze(
        spark,
        {"start_station_id": 7.0, "start_station_name": "A"},
        {"start_station_id": 7.0, "start_station_name": None},
        {"start_station_id": None, "start_station_name": "X"},
        {"start_station_id": None, "start_station_name": "Y"},
    )
    assert all("start_name_drift" not in rules for rules in failed(df).values())


def test_drift_flags_all_rows_of_the_id_in_that_role_only(spark):
    df = bronze(
        spark,
        {"start_station_id": 7.0, "start_station_name": "A"},
        {"start_station_id": 7.0, "start_station_name": "A (old)"},
        {"end_station_id": 7.0, "end_station_name": "A"},
    )
    found = failed(df)
    assert found == {"R0": ["start_name_drift"], "R1": ["start_name_drift"], "R2": []}


def test_drift_across_roles(spark):
    df = bronze(
        spark,
        {"start_station_id": 7.0, "start_station_name": "A"},
        {"end_station_id": 7.0, "end_station_name": "B2"},
    )
    assert failed(df) == {"R0": [], "R1": []}
    found = failed(df, across_roles=True)
    assert found == {"R0": ["start_name_drift"], "R1": ["end_name_drift"]}


def test_several_failures_keep_rule_order(spark):
    df = bronze(spark, {"ride_id": "Z", "start_lat": None, "member_casual": " ", "ended_at": None})
    assert failed(df)["Z"] == ["missing_member_casual", "missing_ended_at", "missing_start_lat"]


def test_split_is_complete_and_disjoint(spark):
    df = bronze(spark, {}, {"start_lat": None}, {"ride_id": None}, {"ended_at": "2024-01-12 00:00:00"})
    clean, bad = quarantine(df)
    assert clean.count() + bad.count() == df.count()
    assert ids(clean) == ["R0"]
    assert "failed_rules" in bad.columns and "failed_rules" not in clean.columns
    assert clean.columns == df.columns


def test_null_key_leaks_only_without_strict(spark):
    flagged = flag(bronze(spark, {}, {"ride_id": None}, {"ride_id": "  "}))
    assert ids(without_quarantined(flagged, "ride_id")) == ["R0"]
    assert ids(without_quarantined(flagged, "ride_id", strict=False)) == ["None", "R0"]


def test_one_bad_copy_removes_all_copies(spark):
    df = bronze(spark, {"ride_id": "D"}, {"ride_id": "D", "end_lat": None}, {"ride_id": "E"}, {"ride_id": "E"})
    assert ids(to_silver(flag(df))) == ["E", "E"]


def test_same_as_a_plain_anti_join(spark):
    df = bronze(
        spark, {"ride_id": "D"}, {"ride_id": "D", "end_lat": None}, {"ride_id": None}, {}, {"ride_id": " "}
    )
    flagged = flag(df)
    plain = excluding_keys(df, bad_rows(flagged), "ride_id")
    assert ids(plain) == ids(without_quarantined(flagged, "ride_id", strict=False))


def test_failures_per_rule(spark):
    bad = bad_rows(flag(bronze(spark, {"start_lat": None}, {"start_lat": None, "end_lat": None}, {})))
    per_rule = failures_by_rule(bad, ["missing_start_lat", "missing_end_lat", "negative_duration"])
    assert {name: ids(rows) for name, rows in per_rule.items()} == {
        "missing_start_lat": ["R0", "R1"],
        "missing_end_lat": ["R1"],
        "negative_duration": [],
    }
    assert failures_long(bad).count() == 3
    assert cells(failure_counts(bad), "failed_rule", "n_rows") == [
        ("missing_start_lat", 2),
        ("missing_end_lat", 1),
    ]


def test_ratio_alarm_is_strict(spark):
    half = bronze(spark, {}, {"start_lat": None})
    assert quarantine_ratio_alarm(bad_rows(flag(half)), half).isEmpty()
    more = bronze(spark, {}, {"start_lat": None}, {"end_lat": None})
    alarm = quarantine_ratio_alarm(bad_rows(flag(more)), more)
    assert cells(alarm, "quarantined", "total") == [(2, 3)]


def test_rule_names_without_comma(spark):
    from ridestrata.operators.rules import Rule

    with pytest.raises(ValueError):
        flag(bronze(spark, {}), [Rule("a,b", F.lit(True))], drift=())


def test_rules_on_another_table(spark):
    """The operators know nothing of trips."""
    from ridestrata.operators.rules import Drift, required_value

    df = spark.createDataFrame(
        [(1, "x", 1.0), (1, "y", 2.0), (2, "z", None), (3, "w", 1.0)], "k int, n string, v double"
    )
    clean, bad = quarantine(df, required_value("v"), [Drift("k_drift", "k", "n")])
    assert ids(clean, "k") == ["3"] and ids(bad, "k") == ["1", "1", "2"]
    assert TRIP_DRIFT[0].id_column == "start_station_id"


def test_rules_judged_once_give_the_same_flags(spark):
    rows = bronze(spark, {}, {"ride_id": "  "}, {"ride_id": "\t"}, {"ride_id": "é", "member_casual": None}, {"ended_at": None, "start_lat": None})
    many = [Rule(f"r{n}", F.length("ride_id") == n % 7) for n in range(70)]
    for rules in (None, many):
        plain, once = (flag(rows, rules, judged_once=given) for given in (False, True))
        assert once.columns == plain.columns
        assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))


def test_months_are_read_from_folders(spark):
    paths = ["file:///a/2024/03/x.csv", "s3a://b/2019/12/2020/01/y.zip"]
    found = with_month(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {(r["path"], r["year"], r["month"]) for r in found} == {(paths[0], 2024, 3), (paths[1], 2020, 1)}
