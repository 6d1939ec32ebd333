"""Data tests that are judged together agree with the same tests one by one."""

import random

import pytest
from pyspark.sql import functions as F

from ridestrata.operators import datatests as dt
from ridestrata.operators.stored import store


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice([None, "a", "b", "c,d", "x"]), rng.choice([None, 0.0, -0.0, 1.5, 31000.0]), rng.randrange(60))
        for _ in range(300)
    ]
    child = store(spark.createDataFrame(rows, "name string, place double, number int"), "child")
    parent = store(
        spark.createDataFrame([("a", 0.0, 1), ("b", 31000.0, 2), (None, None, 3)], "known string, at double, n int"),
        "parent",
    )
    return child, parent


def the_tests(child, parent):
    return [
        dt.checked("unique_number", "unique", child, "number"),
        dt.checked("unique_pair", "unique", child, "name", "place"),
        dt.checked("unique_known", "unique", parent, "known"),
        dt.checked("given_name", "not_null", child, "name"),
        dt.checked("given_number", "not_null", child, "number"),
        dt.checked("allowed_name", "accepted", child, "name", values=("a", "b")),
        dt.checked("allowed_number", "accepted", child, "number", values=tuple(range(60))),
        dt.checked("known_name", "known", child, "name", parent=parent, field="known"),
        dt.checked("known_place", "known", child, "place", parent=parent, field="at"),
        dt.checked("number_as_place", "known", child, "number", parent=parent, field="at"),
        dt.DataTest("own", child.where("number = 3")),
    ]


def test_counts_are_those_of_each_test(tables):
    tests = the_tests(*tables)
    single = {test.name: test.failures.count() for test in tests}
    assert {row.test: row.failures for row in dt.failures_by_test(tests).collect()} == single
    assert dt.failing(tests) == [name for name, n in single.items() if n]
    assert 0 < sum(n > 0 for n in single.values()) < len(single)


def test_failing_values_and_rows(tables):
    child, parent = tables
    rows = dt.failure_rows(the_tests(child, parent)).collect()
    found = {(row.test, row.failing): row.n_rows for row in rows}
    assert len(found) + sum(row.test == "own" for row in rows) >= len(rows)
    lacking = child.where("name in ('c,d', 'x')").groupBy("name").count().collect()
    assert {key[1]: n for key, n in found.items() if key[0] == "known_name"} == {r["name"]: r["count"] for r in lacking}
    assert found["given_name", None] == child.where("name is null").count()
    # 0.0 and -0.0 are one value, which the parent has.
    assert {key[1] for key in found if key[0] == "known_place"} == {"1.5"}


def test_gate_reads_stored_failures(spark, tables):
    child, _ = tables
    fine = [dt.checked("given_number", "not_null", child, "number")]
    stored = store(dt.failure_rows(fine), "failures")
    dt.gate(fine, stored)
    broken = [*fine, dt.checked("unique_number", "unique", child, "number")]
    with pytest.raises(dt.DataTestsFailed, match="unique_number"):
        dt.gate(broken, store(dt.failure_rows(broken), "failures"))


def test_each_table_is_scanned_once(spark, tables, capsys):
    tests = the_tests(*tables)[3:9]
    dt.failures_by_test(tests).explain()
    assert capsys.readouterr().out.count("FileScan") == 2


def test_empty_tables_pass(spark, tables):
    child, parent = tables
    tests = the_tests(child.where(F.lit(False)), parent)
    assert dt.failing(tests) == []
