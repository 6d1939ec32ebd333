"""Splitting a table into clean and quarantined rows by rules."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.operators.rules import (
    TRIP_DRIFT,
    Drift,
    Rule,
    any_failing,
    failing_names,
    trip_rules,
    with_drift,
    with_masks,
)
from ridestrata.operators.stored import lookup_join, store


def flag(
    df: DataFrame,
    rules: list[Rule] | None = None,
    drift: list[Drift] = TRIP_DRIFT,
    across_roles: bool = False,
    drifting: DataFrame | None = None,
    judged_once: bool = False,
) -> DataFrame:
    """All rows with ``is_bad`` and ``failed_rules`` added. ``drifting`` holds the ids
    (role, id) that drift, if they are known from more rows than these. With
    ``judged_once`` every rule looks at every row, once; else one that only ``is_bad``
    needs stops at the first rule that fails."""
    columns = df.columns
    rules = trip_rules() if rules is None else rules
    judged, rules = with_masks(df, rules) if judged_once else (df, rules)
    marked, drift_rules = with_drift(judged, list(drift), across_roles, drifting)
    every = [*rules, *drift_rules]
    return marked.select(
        *columns,
        any_failing(every).alias("is_bad"),
        failing_names(every).alias("failed_rules"),
    )


def bad_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_bad").drop("is_bad")


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where("not is_bad").drop("is_bad", "failed_rules")


def quarantine(
    df: DataFrame,
    rules: list[Rule] | None = None,
    drift: list[Drift] = TRIP_DRIFT,
    across_roles: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(clean, bad): every row goes to exactly one side."""
    flagged = flag(df, rules, drift, across_roles)
    return clean_rows(flagged), bad_rows(flagged)


def excluding_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys``; a NULL key never matches, so its
    row stays (which ``NOT IN`` would not give)."""
    return df.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def without_quarantined(flagged: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Rows of which no copy, by key, is quarantined.

    A bad row excludes itself, so only keys that have both a good and a bad copy
    need a join. They are found with a narrow aggregation (key and flag), and
    the wide rows do not move when there are few of them.

    A NULL key matches nothing: with ``strict=False`` a bad row without a key is
    kept, as a plain anti-join on the key keeps it.
    """
    keep: Column = ~F.col("is_bad")
    if not strict:
        keep = keep | F.col(key).isNull()
    mixed = (
        flagged.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("is_bad").alias("some_bad"), F.min("is_bad").alias("all_bad"))
        .where("some_bad and not all_bad")
        .select(key)
    )
    kept = flagged.where(keep).drop("is_bad", "failed_rules")
    return lookup_join(kept, store(mixed, "mixed-keys"), [key], "left_anti")


def without_bad_keys(flagged: DataFrame, bad_keys: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """``without_quarantined`` where rows outside ``flagged`` may be quarantined too:
    ``bad_keys`` has the keys of all of them, in a column of the same name. Only the keys
    that the kept rows share with them meet the wide rows."""
    keep: Column = ~F.col("is_bad")
    if not strict:
        keep = keep | F.col(key).isNull()
    kept = flagged.where(keep).drop("is_bad", "failed_rules")
    good = kept.select(key, F.lit(False).alias("_bad"))
    copies = good.union(bad_keys.select(key, F.lit(True).alias("_bad"))).where(F.col(key).isNotNull())
    some, every = F.max("_bad").alias("_some"), F.min("_bad").alias("_every")
    mixed = copies.groupBy(key).agg(some, every).where("_some and not _every").select(key)
    mixed = store(mixed, "mixed-keys")
    return lookup_join(kept, mixed, [key], "left_anti")


def failures_by_rule(bad: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """One table of failing rows per rule."""
    return {
        name: bad.where(F.array_contains("failed_rules", name)).drop("failed_rules")
        for name in names
    }


def failures_long(bad: DataFrame) -> DataFrame:
    """One row per failing row and rule, for a single partitioned write."""
    return bad.select("*", F.explode("failed_rules").alias("failed_rule")).drop("failed_rules")


def failure_counts(bad: DataFrame) -> DataFrame:
    """Rows per failed rule, most frequent first."""
    return (
        bad.select(F.explode("failed_rules").alias("failed_rule"))
        .groupBy("failed_rule")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), "failed_rule")
    )


def quarantine_ratio_alarm(
    bad: DataFrame, every: DataFrame, highest: float = 0.50
) -> DataFrame:
    """One row when more than ``highest`` of all rows are quarantined, else none."""
    counts = bad.agg(F.count("*").alias("quarantined")).withColumn(
        "total", every.agg(F.count("*")).scalar()
    )
    return counts.where(F.col("quarantined") > F.lit(highest) * F.col("total"))


def flagged_ratio_alarm(flagged: DataFrame, highest: float = 0.50) -> DataFrame:
    """``quarantine_ratio_alarm`` from flagged rows, in one scan."""
    counts = flagged.agg(F.count_if("is_bad").alias("quarantined"), F.count("*").alias("total"))
    return counts.where(F.col("quarantined") > F.lit(highest) * F.col("total"))
