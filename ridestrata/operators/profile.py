"""Exact quantiles and the ride duration profile."""

from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridestrata.operators.stored import lookup_join, store

# Values are told apart by digits of 16 bits.
_DIGIT_BITS = 16


def _shifts(lowest: int, highest: int) -> list[int]:
    """Digit positions, from one at which the range has at most 65,536 digits
    down to single values."""
    shift = 0
    while (highest >> shift) - (lowest >> shift) >= 1 << _DIGIT_BITS:
        shift += 1
    return [*range(shift, 0, -_DIGIT_BITS), 0]


def _values_at(histogram: DataFrame, ranks: set[int], lowest: int, highest: int) -> dict[int, int]:
    """The values of 0-based ranks in (value, n) rows.

    Each pass counts the rows per digit below the prefixes found so far, at most
    65,536 for each of them, and finds the digit in which every rank lies.
    """
    prefix = {rank: (None, 0) for rank in ranks}
    above = None
    for shift in _shifts(lowest, highest):
        digit = F.shiftright("value", shift).alias("digit")
        within, parent = histogram, F.lit(0)
        if above is not None:
            wanted = sorted({found for found, _ in prefix.values()})
            within = histogram.where(F.shiftright("value", above).isin(wanted))
            parent = F.shiftright("digit", above - shift)
        running = F.sum("n").over(Window.partitionBy("parent").orderBy("digit"))
        digits = (
            within.groupBy(digit)
            .agg(F.sum("n").alias("n"))
            .withColumn("parent", parent)
            .withColumn("running", running)
        )
        hits = [
            (F.col("running") > rank - passed) & (F.col("running") - F.col("n") <= rank - passed)
            & (F.lit(True) if found is None else F.col("parent") == found)
            for rank, (found, passed) in prefix.items()
        ]
        rows = digits.where(reduce(or_, hits)).collect()
        for rank, (found, passed) in prefix.items():
            for row in rows:
                below = row["running"] - row["n"]
                inside = found is None or row["parent"] == found
                if inside and below <= rank - passed < row["running"]:
                    prefix[rank] = (row["digit"], passed + below)
        above = shift
    return {rank: value for rank, (value, _) in prefix.items()}


def exact_quantiles(df: DataFrame, value: Column, shares: list[float]) -> list[float | None]:
    """Quantiles of a BIGINT column with linear interpolation between ranks.

    Equal values are counted first; then the wanted ranks are found digit by
    digit, so no task ever holds all values, as an exact percentile aggregate
    would. Each pass returns one row per rank.
    """
    counted = df.select(value.alias("value")).dropna().groupBy("value")
    histogram = store(counted.agg(F.count("*").alias("n")), "histogram")
    total, lowest, highest = histogram.agg(F.sum("n"), F.min("value"), F.max("value")).first()
    if not total:
        return [None for _ in shares]
    places = [(total - 1) * share for share in shares]
    ranks = {rank for place in places for rank in (floor(place), ceil(place))}
    found = _values_at(histogram, ranks, lowest, highest)
    results = []
    for place in places:
        low, high = floor(place), ceil(place)
        step = (found[high] - found[low]) * (place - low) if high > low else 0
        results.append(found[low] + step)
    return results


def quantiles_by(df: DataFrame, by: list[str], value: Column, shares: list[float]) -> DataFrame:
    """Quantiles of a BIGINT column in each group, with linear interpolation between
    ranks: the columns ``by``, the number of values, the largest, and an array of the
    quantiles in the order of ``shares``. NULL is a group like others; a group without
    values has no row.

    Equal values of a group are counted first. Then all groups look for their ranks at
    once, digit by digit: a pass counts the rows per digit below the prefixes found so
    far, at most 65,536 for each, so a group of any size is shared by many tasks. What
    the groups know lies in a table; the driver sees only the range of all values.
    """
    counted = df.select(F.struct(*by).alias("_group"), value.alias("_value")).dropna(subset=["_value"])
    histogram = store(counted.groupBy("_group", "_value").agg(F.count("*").alias("_n")), "histogram")
    lowest, highest = histogram.agg(F.min("_value"), F.max("_value")).first()
    totals = histogram.groupBy("_group").agg(F.sum("_n").alias("n"), F.max("_value").alias("largest"))
    places = [(F.col("n") - 1).cast("double") * share for share in shares]
    ranks = F.array_distinct(F.array(*[f(place).cast("bigint") for place in places for f in (F.floor, F.ceil)]))
    state = totals.select("_group", F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_passed"), ranks.alias("_ranks"))
    above = None
    for shift in [] if lowest is None else _shifts(lowest, highest):
        state = store(state, "quantile-ranks")
        within = histogram.withColumn("_prefix", F.lit(0).cast("bigint"))
        if above is not None:
            within = histogram.withColumn("_prefix", F.shiftright("_value", above))
            within = lookup_join(within, state.select("_group", "_prefix"), ["_group", "_prefix"], "left_semi")
        digits = within.groupBy("_group", "_prefix", F.shiftright("_value", shift).alias("_digit")).agg(F.sum("_n").alias("_n"))
        running = F.sum("_n").over(Window.partitionBy("_group", "_prefix").orderBy("_digit"))
        spans = lookup_join(digits.withColumn("_running", running), state, ["_group", "_prefix"], "inner")
        below = F.col("_passed") + F.col("_running") - F.col("_n")
        inside = F.filter("_ranks", lambda rank: (rank >= below) & (rank < F.col("_passed") + F.col("_running")))
        hits = spans.withColumns({"_inside": inside, "_below": below}).where(F.size("_inside") > 0)
        state = hits.select("_group", F.col("_digit").alias("_prefix"), F.col("_below").alias("_passed"), F.col("_inside").alias("_ranks"))
        above = shift
    found = state.select("_group", F.col("_prefix").alias("_value"), F.explode("_ranks").alias("_rank"))
    at = F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at")

    def between(place: Column) -> Column:
        low = F.element_at("_at", F.floor(place).cast("bigint"))
        high = F.element_at("_at", F.ceil(place).cast("bigint"))
        return low + (high - low) * (place - F.floor(place))

    quantiles = F.array(*[between(place) for place in places]).alias("quantiles")
    known = totals.join(found.groupBy("_group").agg(at), "_group")
    return known.select(*[F.col("_group")[name].alias(name) for name in by], "n", "largest", quantiles)


def duration_profile(df: DataFrame, micros: Column, shares: list[float] | None = None) -> DataFrame:
    """One row: number of rides with a known length, p50, p99 and longest, in
    minutes."""
    shares = shares or [0.5, 0.99]
    quantiles = exact_quantiles(df, micros, shares)
    minutes = 60_000_000
    return df.select(micros.alias("micros")).agg(
        F.count("micros").alias("rides"),
        *[
            F.round(F.lit(q).cast("double") / minutes, 3).alias(f"p{round(share * 100)}_minutes")
            for share, q in zip(shares, quantiles)
        ],
        F.round(F.max("micros") / minutes, 3).alias("longest_minutes"),
    )
