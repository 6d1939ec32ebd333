from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ridestrata.functions.timezones import (
    in_local_dates,
    instant_to_wall,
    local_date,
    naive,
    utc_naive,
    wall_to_instant,
)

CASES = [
    ("2023-11-05 01:30:00", "2023-11-05 06:30:00"),  # repeated hour: standard time
    ("2023-11-05 00:30:00", "2023-11-05 04:30:00"),
    ("2023-11-05 02:30:00", "2023-11-05 07:30:00"),
    ("2023-03-12 02:30:00", "2023-03-12 07:30:00"),  # in the spring gap
    ("2024-07-01 23:59:59.999", "2024-07-02 03:59:59.999"),
    ("1969-12-31 12:00:00", "1969-12-31 17:00:00"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_wall_to_instant(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(CASES, "wall string, utc string")
        instant = wall_to_instant(naive(F.col("wall")))
        wrong = df.where(utc_naive(instant) != naive(F.col("utc")))
        assert wrong.count() == 0
        back = df.where(~F.col("wall").startswith("2023-03-12"))
        assert back.where(instant_to_wall(instant) != naive(F.col("wall"))).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_text_is_an_error(spark):
    df = spark.createDataFrame([("yesterday",)], "wall string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(naive(F.col("wall"))).collect()


@pytest.mark.parametrize("zone", ["America/New_York", "America/Havana", "America/St_Johns", "America/Sao_Paulo"])
def test_bounds_equal_the_date_comparison(spark, zone):
    """Every quarter hour around changes of the clocks, some of them at midnight."""
    turns = [datetime(2017, 10, 14), datetime(2018, 2, 17), datetime(2023, 11, 4), datetime(2010, 11, 6)]
    starts = spark.createDataFrame([(t,) for t in turns], "t timestamp_ntz")
    steps = F.explode(F.sequence(F.lit(0), F.lit(96 * 3))).alias("step")
    wall = F.timestamp_add("MINUTE", F.col("step") * 15, F.col("t"))
    instants = starts.select("t", steps).select(
        F.timestamp_micros(F.unix_micros(F.to_timestamp_ltz(F.date_format(wall, "yyyy-MM-dd HH:mm:ss")))).alias("i")
    )
    for turn in turns:
        day = date(turn.year, turn.month, turn.day + 1)
        local = local_date(F.col("i"), zone)
        exact = instants.where((local >= F.lit(day)) & (local <= F.lit(day)))
        bounded = instants.where(in_local_dates(F.col("i"), day, day, zone))
        assert exact.count() > 0
        assert exact.exceptAll(bounded).count() == 0
        assert bounded.exceptAll(exact).count() == 0
