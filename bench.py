"""Times the warehouse on the driver tables and prints one JSON line.

Trips are landed once as a bronze table; then every model is built from stored
tables and written, and every ridership query reads the stored star schema. Each
step runs once to warm up and once for its time.
"""

import json
import os
import sys
import tempfile
import time
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parity.spark_queries import QUERIES  # noqa: E402
from parity.trips_fx import holiday_seed, trips_fx  # noqa: E402
from ridestrata.operators.calendar import date_dim, trip_dates  # noqa: E402
from ridestrata.operators.conform import fact, role_union_dim, to_silver  # noqa: E402
from ridestrata.operators.datatests import failing, silver_tests  # noqa: E402
from ridestrata.operators.profile import duration_profile  # noqa: E402
from ridestrata.operators.quarantine import bad_rows, failure_counts, flag  # noqa: E402
from ridestrata.operators.repair import merge_repaired, repair_candidates  # noqa: E402
from ridestrata.operators.rules import ride_micros  # noqa: E402
from ridestrata.operators.stored import store  # noqa: E402
from ridestrata.plans import ridership  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FROM, TO = date(2024, 1, 5), date(2024, 1, 20)
STAR = ("q_star_inner", "q_star_left", "q_test_unique", "q_test_relationship", "q_weather_daily")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    bronze = store(trips_fx(spark, SF_DIR).repartition(int(CPUS)), "bronze")
    seconds: dict[str, float] = {}
    built = {}

    def timed(name, step):
        for _ in range(2):
            started = time.perf_counter()
            result = step()
            seconds[name] = round(time.perf_counter() - started, 3)
        return result

    def model(name, build):
        built[name] = timed(name, lambda: store(build(), name))
        return built[name]

    def answer(name, build):
        timed(name, lambda: build().write.format("noop").mode("overwrite").save())

    flagged = timed("flag", lambda: flag(bronze))
    bad = model("quarantine", lambda: bad_rows(flagged))
    silver = model("silver", lambda: to_silver(flagged))
    stations = model("dim_stations", lambda: role_union_dim(silver))
    trips = model("fct_trips", lambda: fact(silver))
    dates = model("dim_date", lambda: date_dim(trip_dates(trips), holiday_seed(spark)))
    candidates = model("repair", lambda: repair_candidates(bad, stations))
    model("merge_repaired", lambda: merge_repaired(silver, candidates, stations))

    answer("failed_rule_counts", lambda: failure_counts(bad))
    answer("duration_profile", lambda: duration_profile(bronze, ride_micros()))
    answer("range", lambda: ridership.trip_range(trips))
    answer("kpis", lambda: ridership.kpis(trips))
    answer("kpis_bounded", lambda: ridership.kpis(trips, FROM, TO))
    answer("hourly", lambda: ridership.hourly(trips))
    answer("daily", lambda: ridership.daily(trips, dates))
    answer("top_stations", lambda: ridership.top_stations(trips, stations))
    answer("bike_mix", lambda: ridership.bike_mix(trips))
    answer("holiday_effect", lambda: ridership.holiday_effect(trips, dates))
    timed("data_tests", lambda: failing(silver_tests(silver, stations, bad, bronze)))
    for name in STAR:
        answer(name.removeprefix("q_"), lambda: QUERIES[name](spark, SF_DIR))

    print(
        json.dumps(
            {
                "metric": "trip warehouse, models and queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
