"""Bronze trips derived from the ``events`` table, once for Spark and once for
DuckDB, and the small holiday seed used with them. Coordinates are computed in
ten-thousandths of a degree."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestrata.schemas import HOLIDAYS, TRIPS

_TEXT = """
WITH e AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, value,
         31000 + user_id % 50 AS sid,
         31000 + (event_id * 7 + user_id) % 60 AS eid,
         CASE WHEN event_id % 113 = 0 THEN -value
              WHEN event_id % 89 = 0 THEN value + 600
              ELSE value END AS minutes,
         CASE WHEN event_id % 40 = 0 THEN 40 ELSE event_id % 4 END AS joff
  FROM {events}
)
SELECT
  CASE WHEN e % 401 = 0 THEN NULL WHEN e % 397 = 0 THEN '  '
       WHEN e % 307 = 0 THEN 'R' || CAST(e - 1 AS {text})
       ELSE 'R' || CAST(e AS {text}) END AS ride_id,
  CASE WHEN event_type IN ('click', 'view') THEN 'electric_bike'
       WHEN event_type IN ('purchase', 'signup') THEN 'classic_bike'
       ELSE 'docked_bike' END AS rideable_type,
  CAST(ts AS {text}) AS started_at,
  CAST(ts + {seconds} AS {text}) AS ended_at,
  CASE WHEN e % 5 = 0 THEN NULL
       WHEN u % 50 = 3 AND e % 2 = 0 THEN 'Station 31003 (old)'
       ELSE 'Station ' || CAST(sid AS {text}) END AS start_station_name,
  CASE WHEN e % 5 <> 0 THEN CAST(sid AS DOUBLE) END AS start_station_id,
  CASE WHEN e % 8 = 0 THEN NULL
       WHEN eid = 31017 AND e % 2 = 0 THEN 'Station 31017 (old)'
       ELSE 'Station ' || CAST(eid AS {text}) END AS end_station_name,
  CASE WHEN e % 8 <> 0 THEN CAST(eid AS DOUBLE) END AS end_station_id,
  CASE WHEN e % 915 = 0 THEN 38900000.0
       WHEN e % 305 = 0 THEN 389.0
       WHEN e % 211 <> 0 THEN CAST(388000 + (sid % 10) * 200 + joff AS DOUBLE) / 10000 END AS start_lat,
  CASE WHEN e % 211 <> 0
       THEN CAST(((sid - 31000) {div} 10) * 200 + joff - 771000 AS DOUBLE) / 10000 END AS start_lng,
  CASE WHEN e % 223 <> 0 THEN CAST(388000 + (eid % 10) * 200 + joff AS DOUBLE) / 10000 END AS end_lat,
  CASE WHEN e % 488 = 0 THEN -180.5
       WHEN e % 223 <> 0
       THEN CAST(((eid - 31000) {div} 10) * 200 + joff - 771000 AS DOUBLE) / 10000 END AS end_lng,
  CASE WHEN u % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual
FROM e
"""

DUCKDB_TRIPS = _TEXT.format(
    events="events",
    text="VARCHAR",
    seconds="to_seconds(CAST(floor(minutes * 60) AS BIGINT))",
    div="//",
)

SEED = (
    ("US", date(2024, 1, 1), "New Year"),
    ("CA", date(2024, 1, 1), "New Year"),
    ("VN", date(2024, 1, 1), "New Year"),
    ("ET", date(2024, 1, 7), "Genna"),
    ("ER", date(2024, 1, 7), "Lidet"),
    ("US", date(2024, 1, 15), "MLK Day"),
    ("SV", date(2024, 1, 16), "Peace Day"),
    ("IN", date(2024, 1, 26), "Republic Day"),
)

DUCKDB_HOLIDAYS = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{country}', DATE '{day}', '{name}')" for country, day, name in SEED)
    + ") AS v(country, holiday_date, holiday_name)"
)


def trips_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One struct per event, opened again: so Spark derives each value once
    instead of copying its derivation into every filter that reads it, as it
    would not do for a table of trips either."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = _TEXT.format(
        events="{events}",
        text="STRING",
        seconds="make_dt_interval(0, 0, 0, floor(minutes * 60))",
        div="div",
    )
    derived = spark.sql(text, events=events)
    return derived.select(F.inline(F.array(F.struct(*TRIPS.names))))


def holiday_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEED), HOLIDAYS)
