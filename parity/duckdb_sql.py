"""The registered queries as SQL over the same tables, built from shared parts."""

from parity.trips_fx import DUCKDB_HOLIDAYS, DUCKDB_TRIPS
from ridestrata.functions.scalars import COUNTRY_LABELS
from ridestrata.operators.datatests import BIKE_TYPES, REFERENCES, REQUIRED, RIDER_TYPES
from ridestrata.operators.rules import TRIP_TEXT, TRIP_VALUES
from ridestrata.schemas import TRIPS
from ridestrata.operators.weather import WEATHER_COLUMNS

TZ = "'America/New_York'"
FROM, TO = "DATE '2024-01-05'", "DATE '2024-01-20'"
PLACES = "DECIMAL(18, 5)"


def utc_of_wall(wall: str) -> str:
    return f"(({wall} AT TIME ZONE {TZ}) AT TIME ZONE 'UTC')"


def wall_of_utc(utc: str) -> str:
    return f"(({utc} AT TIME ZONE 'UTC') AT TIME ZONE {TZ})"


# Parts: name -> (names of the parts it reads, query).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, reads: str, query: str) -> None:
    PARTS[name] = (tuple(reads.split()), query)


def sql(reads: str, query: str) -> str:
    needed: list[str] = []

    def need(name: str) -> None:
        for other in PARTS[name][0]:
            need(other)
        if name not in needed:
            needed.append(name)

    for name in reads.split():
        need(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name][1]})" for name in needed)
    return f"WITH {parts}\n{query}" if parts else query


CLOCKS = """
    * REPLACE (CAST(started_at AS TIMESTAMP) AS started_at, CAST(ended_at AS TIMESTAMP) AS ended_at)
"""
part("trips", "", f"SELECT {CLOCKS} FROM ({DUCKDB_TRIPS})")

SECONDS = "date_diff('microsecond', started_at, ended_at)"
RULES = {
    **{f"missing_{c}": f"trim({c}) = '' OR {c} IS NULL" for c in TRIP_TEXT},
    **{f"missing_{c}": f"{c} IS NULL" for c in TRIP_VALUES},
    "negative_duration": f"{SECONDS} < 0",
    "over_long_duration": f"{SECONDS} > 30000000000",
    "start_name_drift": "start_station_id IN (SELECT id FROM drifted WHERE role = 'start_name_drift')",
    "end_name_drift": "end_station_id IN (SELECT id FROM drifted WHERE role = 'end_name_drift')",
}
SINGLE = [name for name in RULES if not name.endswith("_drift")]


def failing(names: list[str]) -> str:
    return " OR ".join(f"coalesce({RULES[n]}, FALSE)" for n in names)


def rule_names(names: list[str]) -> str:
    cases = ", ".join(f"CASE WHEN {RULES[n]} THEN '{n}' END" for n in names)
    return f"concat_ws(',', {cases})"


def failing_rows(names: list[str]) -> str:
    return f"SELECT *, {rule_names(names)} AS failed_rules FROM trips WHERE {failing(names)}"


part(
    "named",
    "trips",
    """
    SELECT 'start_name_drift' AS role, start_station_id AS id, start_station_name AS name FROM trips
    UNION ALL
    SELECT 'end_name_drift', end_station_id, end_station_name FROM trips
    """,
)
part(
    "drifted",
    "named",
    """
    SELECT role, id FROM named WHERE id IS NOT NULL
    GROUP BY role, id HAVING min(name) <> max(name)
    """,
)
part(
    "flagged",
    "trips drifted",
    f"SELECT *, ({failing(list(RULES))}) AS is_bad, {rule_names(list(RULES))} AS failed_rules FROM trips",
)
part("bad", "flagged", "SELECT * EXCLUDE (is_bad) FROM flagged WHERE is_bad")
part("bad_rows", "bad", "SELECT row_number() OVER () AS n, * FROM bad")


def conformed(source: str) -> str:
    sides = ", ".join(
        f"CAST(round({s}_station_id) AS INTEGER) AS {s}_stn_id, {s}_station_name AS {s}_stn_name, "
        f"CAST(CAST({s}_lat AS {PLACES}) AS DOUBLE) AS {s}_lat, "
        f"CAST(CAST({s}_lng AS {PLACES}) AS DOUBLE) AS {s}_lng"
        for s in ("start", "end")
    )
    return f"""
    SELECT ride_id, rideable_type, {utc_of_wall('started_at')} AS start_time,
           {utc_of_wall('ended_at')} AS end_time, {sides}, member_casual AS rider_type
    FROM {source}
    """


UNMATCHED = "NOT EXISTS (SELECT 1 FROM bad AS b WHERE b.ride_id = f.ride_id)"
part("silver", "flagged bad", conformed("flagged AS f") + f" WHERE {UNMATCHED}")
part(
    "silver_strict",
    "flagged bad",
    conformed("flagged AS f") + f" WHERE {UNMATCHED} AND NOT is_bad",
)
part(
    "dim",
    "silver",
    """
    SELECT stn_id, stn_name, lat, lng
    FROM (SELECT start_stn_id AS stn_id, start_stn_name AS stn_name, start_lat AS lat, start_lng AS lng
          FROM silver
          UNION ALL
          SELECT end_stn_id, end_stn_name, end_lat, end_lng FROM silver)
    WHERE stn_id IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY stn_id ORDER BY stn_name NULLS LAST, lat NULLS LAST, lng NULLS LAST) = 1
    """,
)
FACT = "ride_id, rideable_type, start_time, end_time, start_stn_id, end_stn_id, rider_type"
part(
    "fct",
    "silver",
    f"SELECT {FACT}, {wall_of_utc('start_time')} AS local_time FROM silver",
)
part("bounded", "fct", f"SELECT * FROM fct WHERE CAST(local_time AS DATE) BETWEEN {FROM} AND {TO}")
part("none", "fct", "SELECT * FROM fct WHERE CAST(local_time AS DATE) >= DATE '2030-01-01'")

LABELS = ", ".join(f"('{code}', '{label}')" for code, label in COUNTRY_LABELS.items())
part("labels10", "", f"SELECT * FROM (VALUES {LABELS}) AS v(code, label)")
part("holidays", "", DUCKDB_HOLIDAYS)
part(
    "dates",
    "fct",
    "SELECT DISTINCT CAST(local_time AS DATE) AS date FROM fct",
)


def listed(holidays: str) -> str:
    order = "ORDER BY coalesce(label, country), holiday_name"
    return f"""
    SELECT holiday_date AS date,
           string_agg(holiday_name, ',' {order}) AS holiday_names,
           string_agg(coalesce(label, country), ',' {order}) AS holiday_countries,
           CAST(count(*) AS INTEGER) AS holiday_count
    FROM {holidays} LEFT JOIN labels10 ON country = code
    GROUP BY holiday_date
    """


part("lists", "holidays labels10", listed("holidays"))


def date_table(off: str) -> str:
    return f"""
    SELECT date AS "Date", dayname(date) AS "Day",
           CAST({off} AS INTEGER) AS "Is_holiday",
           coalesce(holiday_count, 0) AS "Holiday_count",
           CAST(holiday_count IS NOT NULL AND isodow(date) IN (1, 5) AS INTEGER) AS "Long_weekend",
           CAST(holiday_count IS NOT NULL AND isodow(date) IN (2, 4) AS INTEGER) AS "Mini_vac_blocker",
           holiday_names AS "Holiday", holiday_countries AS "Country"
    FROM dates LEFT JOIN lists USING (date)
    """


part("date_dim", "dates lists", date_table("holiday_count IS NOT NULL"))


def snapped(side: str) -> str:
    """Every row on its own: a missing id leaves a row out, a blank or repeated one does not."""
    return f"""
    SELECT p.n, arg_min(d.stn_id, (dist, d.stn_id)) AS stn_id,
           CAST(CAST(min(dist) * 111000 AS DECIMAL(18, 0)) AS DOUBLE) AS metres
    FROM (SELECT n, {side}_lat AS lat, {side}_lng AS lng FROM bad_rows
          WHERE {side}_station_id IS NULL AND ride_id IS NOT NULL) AS p
    CROSS JOIN dim AS d
    CROSS JOIN LATERAL (SELECT sqrt(pow(p.lat - d.lat, 2) + pow((p.lng - d.lng) * 0.778, 2)) AS dist)
    WHERE dist IS NOT NULL
    GROUP BY p.n
    """


part("near_start", "bad_rows dim", snapped("start"))
part("near_end", "bad_rows dim", snapped("end"))


def repaired(side: str) -> str:
    return f"""
    CASE WHEN {side}_station_id IS NOT NULL THEN {side}_station_id
         WHEN near_{side}.metres <= 50 THEN near_{side}.stn_id END AS {side}_stn_id_repaired,
    {side}_station_id IS NULL AND coalesce(near_{side}.metres, 51) <= 50 AS {side}_stn_imputed,
    near_{side}.metres AS {side}_snap_m
    """


part(
    "candidates",
    "bad_rows near_start near_end",
    f"""
    SELECT bad_rows.* EXCLUDE (n), {repaired('start')}, {repaired('end')}
    FROM bad_rows LEFT JOIN near_start USING (n) LEFT JOIN near_end USING (n)
    WHERE coalesce(near_start.metres, near_end.metres) IS NOT NULL
    """,
)
OPEN = " + ".join(
    f"CASE WHEN {side}_stn_imputed AND rule IN "
    f"('missing_{side}_station_id', 'missing_{side}_station_name') THEN 1 ELSE 0 END"
    for side in ("start", "end")
)
part(
    "recovered",
    "candidates",
    f"""
    SELECT c.* FROM candidates AS c
    WHERE (SELECT count(*) FROM (SELECT unnest(string_split(c.failed_rules, ',')) AS rule)
           WHERE {OPEN} = 0) = 0
    """,
)
part(
    "named_recovered",
    "recovered dim",
    """
    SELECT r.* REPLACE (
             start_stn_id_repaired AS start_station_id,
             end_stn_id_repaired AS end_station_id,
             CASE WHEN start_stn_imputed THEN ds.stn_name ELSE start_station_name END
                 AS start_station_name,
             CASE WHEN end_stn_imputed THEN de.stn_name ELSE end_station_name END
                 AS end_station_name)
    FROM recovered AS r
    LEFT JOIN dim AS ds ON ds.stn_id = r.start_stn_id_repaired
    LEFT JOIN dim AS de ON de.stn_id = r.end_stn_id_repaired
    """,
)

part(
    "merged",
    "silver named_recovered",
    "SELECT *, FALSE AS start_stn_imputed, FALSE AS end_stn_imputed FROM silver UNION ALL "
    + conformed("named_recovered").replace(
        "AS rider_type", "AS rider_type, start_stn_imputed, end_stn_imputed"
    ),
)


def kpis(source: str) -> str:
    return f"""
    SELECT count(*) AS trips,
           sum(CASE WHEN rider_type = 'member' THEN 1 ELSE 0 END) AS members,
           round(avg(date_diff('microsecond', start_time, end_time)) / 60000000, 1) AS avg_minutes,
           count(DISTINCT start_stn_id) AS stations_used
    FROM {source}
    """


def kpi_row(source: str, share: bool) -> str:
    extra = (
        ", CASE WHEN trips = 0 THEN 0.0 ELSE round(100.0 * members / trips) END AS member_share_pct"
        if share
        else ""
    )
    return f"""
    SELECT trips, CAST(coalesce(members, 0) AS BIGINT) AS member_trips, avg_minutes,
           stations_used{extra}
    FROM ({kpis(source)})
    """


def hourly(source: str, extra: str = "") -> str:
    return f"""
    SELECT CAST(hour(local_time) AS INTEGER) AS hour,
           count(*) FILTER (rider_type = 'member') AS member,
           count(*) FILTER (rider_type = 'casual') AS casual{extra}
    FROM {source} GROUP BY ALL
    """


def daily(source: str) -> str:
    return f"""
    SELECT local_day AS day, trips, coalesce("Is_holiday", 0) AS is_holiday,
           coalesce("Long_weekend", 0) AS long_weekend,
           "Holiday" AS holiday_names, "Country" AS holiday_countries
    FROM (SELECT CAST(local_time AS DATE) AS local_day, count(*) AS trips FROM {source} GROUP BY 1)
    LEFT JOIN date_dim ON "Date" = local_day
    """


def busiest(source: str, limit: int) -> str:
    return f"""
    SELECT d.stn_id, d.stn_name, d.lat, d.lng, n AS departures
    FROM (SELECT start_stn_id, count(*) AS n FROM {source} GROUP BY 1) AS f
    JOIN dim AS d ON d.stn_id = f.start_stn_id
    ORDER BY n DESC, d.stn_id LIMIT {limit}
    """


def test_row(name: str, failures: str) -> str:
    return f"SELECT '{name}' AS test, count(*) AS failures FROM ({failures}) AS t"


def allowed(column: str, values: list[str]) -> str:
    listing = ", ".join(f"'{v}'" for v in values)
    return f"SELECT DISTINCT {column} FROM silver WHERE {column} NOT IN ({listing})"


DATA_TESTS = "\nUNION ALL\n".join(
    [
        test_row(
            "unique_ride_id",
            "SELECT ride_id FROM silver WHERE ride_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        ),
        *[test_row(f"not_null_{c}", f"SELECT 1 FROM silver WHERE {c} IS NULL") for c in REQUIRED],
        test_row("accepted_rideable_type", allowed("rideable_type", BIKE_TYPES)),
        test_row("accepted_rider_type", allowed("rider_type", RIDER_TYPES)),
        *[
            test_row(
                f"known_{c}",
                f"SELECT DISTINCT {c} FROM silver AS s WHERE {c} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM dim AS d WHERE d.{field} = s.{c})",
            )
            for c, field in REFERENCES
        ],
        test_row(
            "quarantined_share",
            "SELECT 1 WHERE (SELECT count(*) FROM bad) > 0.5 * (SELECT count(*) FROM trips)",
        ),
    ]
)

# Failing values as text, with their rows.
TEST_FAILURES = "\nUNION ALL\n".join(
    [
        "SELECT 'unique_ride_id' AS test, ride_id AS failing, count(*) AS n_rows FROM silver "
        "WHERE ride_id IS NOT NULL GROUP BY ride_id HAVING count(*) > 1",
        *[
            f"SELECT 'not_null_{c}', NULL, count(*) FROM silver WHERE {c} IS NULL HAVING count(*) > 0"
            for c in REQUIRED
        ],
        *[
            f"SELECT 'known_{c}', CAST({c} AS VARCHAR), count(*) FROM silver AS s WHERE {c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM dim AS d WHERE d.{field} = s.{c}) GROUP BY {c}"
            for c, field in REFERENCES
        ],
    ]
)

CODES = ", ".join(f"'{code}'" for code in COUNTRY_LABELS)
WEATHER = ", ".join(
    f'CAST(embedding[1 + ({i * 10} + d) % 64] AS DOUBLE) AS "{name}"'
    for i, name in enumerate(WEATHER_COLUMNS[1:])
)
part(
    "local_weather",
    "",
    f"""
    SELECT cell_lat, cell_lng, {", ".join(f'"{name}"' for name in WEATHER_COLUMNS)}
    FROM (SELECT *, row_number() OVER (
              PARTITION BY cell_lat, cell_lng, "Date"
              ORDER BY a * a + b * b, latitude, longitude, {", ".join(f'"{name}"' for name in WEATHER_COLUMNS[1:])}) AS place
          FROM (SELECT *, latitude / 0.02 - cell_lat AS a, longitude / 0.02 - cell_lng AS b
                FROM (SELECT *, CAST(floor(latitude / 0.02 + 0.5) AS BIGINT) AS cell_lat,
                             CAST(floor(longitude / 0.02 + 0.5) AS BIGINT) AS cell_lng
                      FROM (SELECT CAST(3880 + vec_id % 7 * 2 AS DOUBLE) / 100 AS latitude,
                                   CAST(vec_id // 7 % 5 * 3 - 7710 AS DOUBLE) / 100 AS longitude,
                                   DATE '2024-01-01' + CAST(vec_id % 5 + d AS INTEGER) AS "Date", {WEATHER}
                            FROM embeddings, range(64) AS r(d)))))
    WHERE place = 1
    """,
)
part(
    "met",
    "silver local_weather",
    f"""
    SELECT t.*, w.* EXCLUDE (cell_lat, cell_lng, "Date")
    FROM (SELECT CAST({wall_of_utc('start_time')} AS DATE) AS "Date",
                 CAST(floor(CAST(start_lat AS DOUBLE) / 0.02 + 0.5) AS BIGINT) AS cell_lat,
                 CAST(floor(CAST(start_lng AS DOUBLE) / 0.02 + 0.5) AS BIGINT) AS cell_lng,
                 count(*) AS trips
          FROM silver GROUP BY ALL) AS t
    LEFT JOIN local_weather AS w USING (cell_lat, cell_lng, "Date")
    """,
)
ALL_TRIPS = sql("trips", "SELECT * FROM trips")

# Records of landed files: each by the second of its start.
part("landed", "", f"SELECT *, second(CAST(started_at AS TIMESTAMP)) AS second FROM ({DUCKDB_TRIPS})")
CHANGED = {
    "started_at": "CASE WHEN second IN (17, 19) THEN 'yesterday' ELSE started_at END",
    "start_lat": "CASE WHEN second IN (13, 19) THEN 'north' ELSE CAST(start_lat AS VARCHAR) END",
}
FIELDS = [f"coalesce(CAST({CHANGED.get(name, name)} AS VARCHAR), '')" for name in TRIPS.names]
MALFORMED = f"""
    SELECT CASE WHEN second = 7 THEN {" || ',' || ".join(FIELDS[:-1])}
                ELSE {" || ',' || ".join(FIELDS)} || CASE WHEN second = 11 THEN ',extra' ELSE '' END END AS record,
           CASE WHEN second IN (7, 11) THEN 'fields' WHEN second = 13 THEN 'number_start_lat'
                WHEN second = 17 THEN 'time_started_at' ELSE 'time_started_at,number_start_lat' END AS reasons
    FROM landed WHERE second IN (7, 11, 13, 17, 19)
"""
ONCE = f"""SELECT * FROM ({PARTS["trips"][1]}) AS t WHERE ride_id IS NULL OR ride_id IN
    (SELECT ride_id FROM ({PARTS["trips"][1]}) AS u GROUP BY 1 HAVING count(*) = 1)"""
SHIFTED = """
    SELECT event_id, 'autumn' AS season, ts - INTERVAL 67 DAY AS wall FROM events
    UNION ALL
    SELECT event_id, 'spring', ts + INTERVAL 55 DAY FROM events
"""
RATIO = """
    SELECT * FROM (SELECT (SELECT count(*) FROM bad) AS quarantined,
                          (SELECT count(*) FROM trips) AS total)
    WHERE quarantined > {} * total
"""

ORACLE = {
    "q_bronze_scan": ALL_TRIPS,
    "q_rule_required": sql(
        "trips", failing_rows([n for n in RULES if n.startswith("missing_")])
    ),
    "q_rule_duration": sql("trips", failing_rows(["negative_duration", "over_long_duration"])),
    "q_rule_drift_start": sql("trips drifted", failing_rows(["start_name_drift"])),
    "q_rule_drift_end": sql("trips drifted", failing_rows(["end_name_drift"])),
    "q_drifting_ids": sql("drifted", "SELECT role, id FROM drifted"),
    "q_drifting_ids_across_roles": sql(
        "named",
        "SELECT 'any' AS role, id FROM named WHERE id IS NOT NULL "
        "GROUP BY id HAVING count(DISTINCT name) > 1",
    ),
    "q_quarantine": sql("bad", "SELECT * FROM bad"),
    "q_clean": sql(
        "flagged", "SELECT * EXCLUDE (is_bad, failed_rules) FROM flagged WHERE NOT is_bad"
    ),
    "q_failed_rule_counts": sql(
        "bad",
        "SELECT failed_rule, count(*) AS n_rows FROM "
        "(SELECT unnest(string_split(failed_rules, ',')) AS failed_rule FROM bad) GROUP BY 1",
    ),
    "q_failures_by_rule": sql(
        "bad",
        "SELECT * EXCLUDE (failed_rules), unnest(string_split(failed_rules, ',')) AS failed_rule "
        "FROM bad",
    ),
    "q_quarantine_ratio": sql("bad trips", RATIO.format("0.25")),
    "q_quarantine_ratio_passes": sql("bad trips", RATIO.format("0.5")),
    "q_silver_parity": sql("silver", "SELECT * FROM silver"),
    "q_silver_strict": sql("silver_strict", "SELECT * FROM silver_strict"),
    "q_anti_join": sql("trips bad", f"SELECT * FROM trips AS f WHERE {UNMATCHED}"),
    "q_dim_station": sql("dim", "SELECT * FROM dim"),
    "q_destination_only": sql(
        "silver",
        "SELECT DISTINCT end_stn_id AS stn_id FROM silver WHERE end_stn_id IS NOT NULL "
        "AND end_stn_id NOT IN (SELECT start_stn_id FROM silver WHERE start_stn_id IS NOT NULL)",
    ),
    "q_fact": sql("silver", f"SELECT {FACT} FROM silver"),
    "q_snap_start": sql(
        "bad_rows near_start",
        "SELECT ride_id, start_lat, start_lng, stn_id AS start_near_stn, metres AS start_snap_m "
        "FROM near_start JOIN bad_rows USING (n)",
    ),
    "q_snap_end": sql(
        "bad_rows near_end",
        "SELECT ride_id, end_lat, end_lng, stn_id AS end_near_stn, metres AS end_snap_m "
        "FROM near_end JOIN bad_rows USING (n)",
    ),
    "q_snap_within_radius": sql(
        "bad_rows near_start",
        "SELECT ride_id, start_lat, start_lng, stn_id AS start_near_stn, metres AS start_snap_m "
        "FROM near_start JOIN bad_rows USING (n) WHERE metres <= 50",
    ),
    "q_repair": sql("candidates", "SELECT * FROM candidates"),
    "q_merge_repaired": sql("merged", "SELECT * FROM merged"),
    "q_kpis_repaired": sql("merged", kpi_row("merged", share=False)),
    "q_month_run": sql("silver", "SELECT * FROM silver"),
    "q_months_one_by_one": sql("silver", "SELECT * FROM silver"),
    "q_quarantine_by_month": sql("bad", "SELECT * FROM bad"),
    "q_streamed_quarantine": sql("bad", "SELECT * FROM bad"),
    "q_calendar_sink": sql("date_dim", "SELECT * FROM date_dim"),
    "q_tested_run": sql("silver_strict", "SELECT * FROM silver_strict").replace(PARTS["trips"][1], ONCE, 1),
    "q_failing_tests": sql("silver dim bad trips", f"SELECT test FROM ({DATA_TESTS}) WHERE failures > 0"),
    "q_test_failures": sql("silver dim", TEST_FAILURES),
    "q_stored_cube": sql("bounded", kpi_row("bounded", share=False)),
    "q_gold_repaired": sql(
        "merged", f"SELECT {FACT}, start_stn_imputed, end_stn_imputed FROM merged"
    ),
    "q_backfill": sql(
        "trips",
        "SELECT *, 2024 AS year, CAST(1 + day(started_at) % 3 AS INTEGER) AS month FROM trips",
    ),
    "q_recovery_summary": sql(
        "trips bad recovered",
        """
        SELECT *, round(100.0 * quarantined / total, 1) AS quarantined_pct,
               round(100.0 * recovered / quarantined, 1) AS recovered_pct,
               round(100.0 * unusable / quarantined, 1) AS unusable_pct
        FROM (SELECT *, quarantined - recovered AS unusable
              FROM (SELECT (SELECT count(*) FROM trips) AS total,
                           (SELECT count(*) FROM bad) AS quarantined,
                           (SELECT count(*) FROM recovered) AS recovered))
        """,
    ),
    "q_range": sql(
        "fct",
        "SELECT CAST(min(local_time) AS DATE) AS min_date, "
        "CAST(max(local_time) AS DATE) AS max_date, count(*) AS trips FROM fct",
    ),
    "q_kpis": sql("fct", kpi_row("fct", share=False)),
    "q_kpis_bounded": sql("bounded", kpi_row("bounded", share=True)),
    "q_kpis_empty": sql("none", kpi_row("none", share=True)),
    "q_hourly": sql("fct", hourly("fct")),
    "q_hourly_bounded": sql(
        "bounded",
        hourly("bounded", ", lpad(CAST(hour(local_time) AS VARCHAR), 2, '0') AS hour_label"),
    ),
    "q_daily": sql("fct date_dim", daily("fct")),
    "q_daily_bounded": sql("bounded date_dim", daily("bounded")),
    "q_bike_mix": sql("fct", "SELECT rideable_type, count(*) AS trips FROM fct GROUP BY 1"),
    "q_top_stations": sql("fct dim", busiest("fct", 10)),
    "q_top_stations_bounded": sql(
        "bounded dim",
        "SELECT *, CAST(row_number() OVER (ORDER BY departures DESC, stn_id) AS INTEGER) AS rank, "
        "round(100.0 * departures / max(departures) OVER (), 1) AS share_of_max_pct "
        f"FROM ({busiest('bounded', 25)})",
    ),
    "q_holiday_effect": sql(
        "fct date_dim",
        f"""
        SELECT CASE WHEN is_holiday = 1 THEN 'Holiday' ELSE 'Ordinary' END AS day_kind,
               round(avg(trips), 0) AS avg_trips, count(*) AS days
        FROM ({daily('fct')}) GROUP BY 1
        """,
    ),
    "q_cube_range": sql(
        "fct",
        "SELECT CAST(min(local_time) AS DATE) AS min_date, "
        "CAST(max(local_time) AS DATE) AS max_date, count(*) AS trips FROM fct",
    ),
    "q_cube_kpis_bounded": sql("bounded", kpi_row("bounded", share=True)),
    "q_cube_kpis_empty": sql("none", kpi_row("none", share=True)),
    "q_cube_daily_bounded": sql("bounded date_dim", daily("bounded")),
    "q_cube_bike_mix": sql("fct", "SELECT rideable_type, count(*) AS trips FROM fct GROUP BY 1"),
    "q_duration_profile": sql(
        "trips",
        f"""
        SELECT count(us) AS rides,
               round(quantile_cont(us, 0.5) / 60000000, 3) AS p50_minutes,
               round(quantile_cont(us, 0.99) / 60000000, 3) AS p99_minutes,
               round(max(us) / 60000000, 3) AS longest_minutes
        FROM (SELECT {SECONDS} AS us FROM trips)
        """,
    ),
    "q_duration_by_bike_and_day": sql(
        "trips",
        f"""
        SELECT rideable_type, CAST(started_at AS DATE) AS day, count(us) AS rides,
               round(quantile_cont(us, 0.5) / 1000000, 3) AS p50_seconds,
               round(quantile_cont(us, 0.9) / 1000000, 3) AS p90_seconds,
               round(quantile_cont(us, 0.99) / 1000000, 3) AS p99_seconds,
               round(max(us) / 1000000, 3) AS longest_seconds
        FROM (SELECT *, {SECONDS} AS us FROM trips) WHERE us IS NOT NULL GROUP BY ALL
        """,
    ),
    "q_date_dim": sql("date_dim", "SELECT * FROM date_dim"),
    "q_date_dim_weekends": sql(
        "dates lists", date_table("holiday_count IS NOT NULL OR isodow(date) IN (6, 7)")
    ),
    "q_holiday_lists": sql(
        "labels10",
        listed(
            f"""(SELECT DISTINCT list_extract([{CODES}], CAST(o_custkey % 10 + 1 AS INTEGER))
                        AS country, CAST(o_orderdate AS DATE) AS holiday_date,
                        o_orderpriority AS holiday_name FROM orders)"""
        ),
    ),
    "q_weather_daily": f"""
        SELECT CAST(vec_id % 90 AS DOUBLE) AS latitude, CAST(vec_id AS DOUBLE) AS longitude,
               DATE '2024-01-01' + CAST(vec_id % 5 + d AS INTEGER) AS "Date", {WEATHER}
        FROM embeddings, range(64) AS r(d)
    """,
    "q_weather_cells": sql("local_weather", "SELECT * FROM local_weather"),
    "q_trips_in_weather": sql("met", "SELECT * FROM met"),
    "q_daily_weather": sql(
        "fct date_dim met",
        f"""
        SELECT d.*, trips_with_weather, warmest, most_rain FROM ({daily('fct')}) AS d
        LEFT JOIN (SELECT "Date" AS day,
                          CAST(sum(CASE WHEN "Temp_max" IS NOT NULL THEN trips ELSE 0 END) AS BIGINT) AS trips_with_weather,
                          max("Temp_max") AS warmest, max("Rain") AS most_rain FROM met GROUP BY 1) USING (day)
        """,
    ),
    "q_array_to_rows": """
        SELECT vec_id, label, CAST(i AS INTEGER) AS place, CAST(embedding[i] AS DOUBLE) AS embedding
        FROM embeddings, range(1, 65) AS r(i)
    """,
    "q_star_inner": """
        SELECT s_suppkey, s_name, n_name, count(*) AS lines
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey
        GROUP BY s_suppkey, s_name, n_name ORDER BY lines DESC, s_suppkey LIMIT 20
    """,
    "q_star_left": """
        SELECT day, lines, orders
        FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem GROUP BY 1)
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
        USING (day)
    """,
    "q_test_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "q_test_not_null": sql("trips", "SELECT * FROM trips WHERE start_station_id IS NULL"),
    "q_test_accepted": """
        SELECT o_orderpriority, count(*) AS n_rows FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1
    """,
    "q_test_relationship": """
        SELECT o_custkey, count(*) AS n_rows FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer
                          WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
        GROUP BY o_custkey
    """,
    "q_data_tests": sql("silver dim bad trips", DATA_TESTS),
    "q_wall_clock": f"""
        WITH shifted AS ({SHIFTED}),
        instants AS (SELECT *, {utc_of_wall('wall')} AS instant FROM shifted)
        SELECT *, {wall_of_utc('instant')} AS wall_again,
               CAST({wall_of_utc('instant')} AS DATE) AS local_day,
               CAST(hour({wall_of_utc('instant')}) AS INTEGER) AS local_hour
        FROM instants
    """,
    "q_label_map": sql(
        "labels10",
        f"""
        SELECT coalesce(label, c) AS country, count(*) AS events
        FROM (SELECT list_extract([{CODES}, 'FR', 'DE'], CAST(user_id % 12 + 1 AS INTEGER)) AS c
              FROM events)
        LEFT JOIN labels10 ON c = code GROUP BY 1
        """,
    ),
    "q_month_keys": """
        SELECT strftime(o_orderdate, '%Y%m') AS month_key, count(*) AS orders
        FROM orders GROUP BY 1
    """,
    "q_zip_scan": ALL_TRIPS,
    "q_csv_scan": ALL_TRIPS,
    "q_readable_zips": sql(
        "trips",
        "SELECT 2024 AS year, CAST(1 + day(started_at) % 3 AS INTEGER) AS month, "
        "rideable_type <> 'docked_bike' AS readable, count(*) AS trips FROM trips GROUP BY ALL",
    ),
    "q_create_only_sink": ALL_TRIPS,
    "q_self_rebuild": ALL_TRIPS,
    "q_malformed_rows": sql("landed", MALFORMED),
    "q_readable_rows": sql(
        "landed", f"SELECT {CLOCKS.strip()} FROM (SELECT * EXCLUDE (second) FROM landed WHERE second NOT IN (7, 11, 13, 17, 19))"
    ),
    "q_overwrite_partition": ALL_TRIPS,
    "q_param_sql": f"""
        SELECT event_type, count(*) AS events, round(max(value), 2) AS largest
        FROM events WHERE ts >= {FROM} GROUP BY event_type
    """,
    "q_sql_file": """
        SELECT event_type, count(*) AS days, CAST(sum(n) AS BIGINT) AS events, max(n) AS busiest
        FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
        GROUP BY event_type
    """,
}

#: Answers from the cube are those from the trips.
ORACLE |= {f"q_cube_{name}": ORACLE[f"q_{name}"] for name in ("hourly_bounded", "top_stations_bounded", "holiday_effect")}
ORACLE["q_weather_landed"] = ORACLE["q_weather_daily"]
ORACLE["q_zip_folders"] = ORACLE["q_backfill"]
