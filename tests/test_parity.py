"""Every registered query against DuckDB on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from parity.duckdb_sql import ORACLE
from parity.spark_queries import QUERIES
from tests.compare import difference, duckdb_over

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry_returns_days(spark):
    assert entry.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert difference(result, connection, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["q_wall_clock", "q_daily", "q_kpis_bounded", "q_silver_strict"])
@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, connection, name, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        result = entry.queries()[name](spark, SF_DIR)
        assert difference(result, connection, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
