"""Data tests. Each returns the failures as a DataFrame; no rows means passed.

NULL passes every test but ``not_null``. Values are counted before they are
compared, so equal values cross the network once per task.

A test that says what it checks (``Check``) is judged together with the other
tests of its table: one scan of the table, and one of each table it refers to.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _counted(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n_rows"))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return _counted(df, list(columns)).where("n_rows > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return _counted(df, [column]).where(~F.col(column).isin(values))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values of the child that the parent lacks, with their number of rows."""
    known = parent.select(F.col(field).alias(column)).dropna().distinct()
    return _counted(child, [column]).join(known, column, "left_anti")


@dataclass(frozen=True)
class Check:
    """What a test asks of a table: ``unique``, ``not_null``, ``accepted`` (one of
    ``values``) or ``known`` (in ``field`` of ``parent``)."""

    kind: str
    table: DataFrame
    columns: tuple[str, ...]
    values: tuple = ()
    parent: DataFrame | None = None
    field: str | None = None


@dataclass(frozen=True)
class DataTest:
    name: str
    failures: DataFrame
    check: Check | None = None


def checked(name: str, kind: str, table: DataFrame, *columns: str, **more) -> DataTest:
    """A test that can be judged together with others of its table."""
    check = Check(kind, table, columns, **more)
    if kind == "unique":
        return DataTest(name, unique(table, *columns), check)
    if kind == "not_null":
        return DataTest(name, not_null(table, *columns), check)
    if kind == "accepted":
        return DataTest(name, accepted_values(table, *columns, list(check.values)), check)
    if kind == "known":
        return DataTest(name, relationships(table, *columns, check.parent, check.field), check)
    raise ValueError(f"no data test is called {kind!r}")


class DataTestsFailed(Exception):
    pass


# Fixed values the silver columns may take.
BIKE_TYPES = ["classic_bike", "electric_bike", "docked_bike"]
RIDER_TYPES = ["member", "casual"]

REQUIRED = (
    "ride_id",
    "rideable_type",
    "start_time",
    "end_time",
    "start_lat",
    "start_lng",
    "rider_type",
)
REFERENCES = (
    ("start_stn_id", "stn_id"),
    ("start_stn_name", "stn_name"),
    ("end_stn_id", "stn_id"),
    ("end_stn_name", "stn_name"),
)


def silver_tests(silver: DataFrame, stations: DataFrame, alarm: DataFrame) -> list[DataTest]:
    """The contract of the silver table and the alarm on the quarantined share."""
    return [
        checked("unique_ride_id", "unique", silver, "ride_id"),
        *[checked(f"not_null_{c}", "not_null", silver, c) for c in REQUIRED],
        checked("accepted_rideable_type", "accepted", silver, "rideable_type", values=tuple(BIKE_TYPES)),
        checked("accepted_rider_type", "accepted", silver, "rider_type", values=tuple(RIDER_TYPES)),
        *[
            checked(f"known_{column}", "known", silver, column, parent=stations, field=field)
            for column, field in REFERENCES
        ],
        DataTest("quarantined_share", alarm),
    ]


def not_empty(df: DataFrame) -> DataFrame:
    """One row if the table has none."""
    return df.limit(1).agg(F.count("*").alias("rows")).where("rows = 0")


def _as_text(df: DataFrame, name: str) -> Column:
    """Equal values of a column as equal texts, different ones as different texts."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0).cast(kind)  # so that -0.0 is 0.0
    return column.cast("string")


def _same_types(check: Check) -> bool:
    """Texts stand for values only within one type."""
    if check.kind != "known":
        return True
    return check.table.schema[check.columns[0]].dataType == check.parent.schema[check.field].dataType


def _key(df: DataFrame, columns: tuple[str, ...]) -> Column:
    return F.array(*[_as_text(df, name) for name in columns])


def _asked(test: DataTest) -> Column:
    """(test, key) of a row that has to be counted for a test, else NULL."""
    check = test.check
    given = reduce(and_, (F.col(name).isNotNull() for name in check.columns))
    key = _key(check.table, check.columns)
    if check.kind == "not_null":
        given, key = ~given, F.array(F.lit(None).cast("string"))
    elif check.kind == "accepted":
        given = given & ~F.col(check.columns[0]).isin(*check.values)
    return F.when(given, F.struct(F.lit(test.name).alias("test"), key.alias("key")))


def _by_table(tests: list[DataTest], table: Callable[[DataTest], DataFrame]) -> list[list[DataTest]]:
    groups: dict[int, list[DataTest]] = {}
    for test in tests:
        groups.setdefault(id(table(test)), []).append(test)
    return list(groups.values())


def _together(tests: list[DataTest]) -> DataFrame:
    """(test, key, n_rows) of the failures of tests of one table, from one scan of it."""
    asked = F.inline(F.array_compact(F.array(*[_asked(test) for test in tests])))
    counted = tests[0].check.table.select(asked).groupBy("test", "key").agg(F.count("*").alias("n_rows"))
    single = [test.name for test in tests if test.check.kind == "unique"]
    failed = counted.where(~F.col("test").isin(*single) | (F.col("n_rows") > 1)) if single else counted
    references = [test for test in tests if test.check.kind == "known"]
    for group in _by_table(references, lambda test: test.check.parent):
        parent = group[0].check.parent
        known = [F.struct(F.lit(t.name).alias("test"), _key(parent, (t.check.field,)).alias("key")) for t in group]
        failed = failed.join(parent.select(F.inline(F.array(*known))).distinct(), ["test", "key"], "left_anti")
    return failed


def failure_rows(tests: list[DataTest]) -> DataFrame:
    """(test, failing, n_rows): each failing value as text, NULL where a value is missing,
    with its number of rows. Rows of tests without a check come as JSON."""
    apart = [test for test in tests if test.check is None or not _same_types(test.check)]
    joint = [test for test in tests if test not in apart]
    found = [
        _together(group).select("test", F.when(F.get("key", F.lit(0)).isNotNull(), F.array_join("key", ",")).alias("failing"), "n_rows")
        for group in _by_table(joint, lambda test: test.check.table)
    ]
    found += [
        test.failures.select(F.lit(test.name).alias("test"), F.to_json(F.struct("*")).alias("failing"), F.lit(1).cast("bigint").alias("n_rows"))
        for test in apart
    ]
    return reduce(DataFrame.union, found)


def failures_by_test(tests: list[DataTest]) -> DataFrame:
    """(test, failures) of every test: how many rows its ``failures`` has."""
    by_row = [test.name for test in tests if test.check and test.check.kind == "not_null"]
    rows = F.when(F.col("test").isin(*by_row), F.col("n_rows")).otherwise(1)
    spark = tests[0].failures.sparkSession
    none = spark.createDataFrame([(test.name, 0) for test in tests], "test string, failures bigint")
    found = failure_rows(tests).select("test", rows.alias("failures"))
    return none.union(found).groupBy("test").agg(F.sum("failures").alias("failures"))


def failing(tests: list[DataTest], found: DataFrame | None = None) -> list[str]:
    """Names of the tests that have failures, in one job; of stored ``failure_rows`` if
    they are given."""
    rows = failure_rows(tests) if found is None else found
    failed = {row.test for row in rows.select("test").distinct().collect()}
    return [t.name for t in tests if t.name in failed]


def gate(tests: list[DataTest], found: DataFrame | None = None) -> None:
    names = failing(tests, found)
    if names:
        raise DataTestsFailed(f"data tests with failures: {', '.join(names)}")
