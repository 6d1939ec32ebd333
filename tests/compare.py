"""Compares a Spark result with DuckDB's over the same tables."""

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return ("f", repr(round(value, 9) + 0.0))
    return ("n",) if value is None else (type(value).__name__, str(value))


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df: DataFrame, connection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    found = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    if len(expected) != len(found):
        return f"{len(found)} rows instead of {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"{a} instead of {b}"
    return None
