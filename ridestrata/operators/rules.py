"""Row rules: named conditions that are true for a failing row.

A rule whose condition is NULL does not fail the row.
"""

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.scalars import blank
from ridestrata.functions.timezones import micros_between, naive, wall_to_instant
from ridestrata.operators.stored import lookup_join, measured_bytes, store

LONGEST_RIDE = timedelta(minutes=500)

TRIP_TEXT = (
    "ride_id",
    "rideable_type",
    "start_station_name",
    "end_station_name",
    "member_casual",
)
TRIP_VALUES = (
    "started_at",
    "ended_at",
    "start_station_id",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
)


@dataclass(frozen=True)
class Rule:
    name: str
    failing: Column


@dataclass(frozen=True)
class Drift:
    """The same identifier seen under more than one name."""

    name: str
    id_column: str
    name_column: str


TRIP_DRIFT = (
    Drift("start_name_drift", "start_station_id", "start_station_name"),
    Drift("end_name_drift", "end_station_id", "end_station_name"),
)


def required_text(*columns: str) -> list[Rule]:
    return [Rule(f"missing_{c}", blank(F.col(c))) for c in columns]


def required_value(*columns: str) -> list[Rule]:
    return [Rule(f"missing_{c}", F.col(c).isNull()) for c in columns]


def ride_micros(basis: str = "wall") -> Column:
    """Ride length in microseconds. ``wall`` subtracts the clock readings as
    they are, ``instant`` takes a change of the clocks during the ride into
    account."""
    start, end = naive(F.col("started_at")), naive(F.col("ended_at"))
    if basis == "wall":
        return micros_between(start, end)
    if basis == "instant":
        return F.unix_micros(wall_to_instant(end)) - F.unix_micros(wall_to_instant(start))
    raise ValueError(f"duration basis {basis!r} is neither 'wall' nor 'instant'")


def ride_length(longest: timedelta = LONGEST_RIDE, basis: str = "wall") -> list[Rule]:
    micros = ride_micros(basis)
    return [
        Rule("negative_duration", micros < 0),
        Rule("over_long_duration", micros > longest // timedelta(microseconds=1)),
    ]


def trip_rules(longest: timedelta = LONGEST_RIDE, basis: str = "wall") -> list[Rule]:
    return [
        *required_text(*TRIP_TEXT),
        *required_value(*TRIP_VALUES),
        *ride_length(longest, basis),
    ]


def roles_of(drift: list[Drift], across_roles: bool = False) -> Column:
    """(role, id, name) of a row's identifiers, as an array."""
    return F.array(
        *[
            F.struct(
                F.lit("any" if across_roles else d.name).alias("role"),
                F.col(d.id_column).alias("id"),
                F.col(d.name_column).alias("name"),
            )
            for d in drift
        ]
    )


def names_by_role(
    df: DataFrame, drift: list[Drift], across_roles: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct (role, id, name) of all identifiers, and the columns ``by``. All roles are
    read in one scan. Equal rows collapse before the shuffle, so a hot station costs one
    row per task. With ``across_roles`` all roles are one."""
    roles = roles_of(drift, across_roles)
    return df.select(*by, F.inline(roles)).where("id is not null and name is not null").distinct()


def of_several_names(names: DataFrame) -> DataFrame:
    """(role, id) of the identifiers that have several names, from distinct names."""
    return names.groupBy("role", "id").count().where("count > 1").select("role", "id")


def drifting_ids(df: DataFrame, drift: list[Drift], across_roles: bool = False) -> DataFrame:
    """(role, id) of every identifier that carries several names; with ``across_roles``
    the names of all roles are compared with each other."""
    return of_several_names(names_by_role(df, drift, across_roles))


def with_drift(
    df: DataFrame, drift: list[Drift], across_roles: bool = False, found: DataFrame | None = None
) -> tuple[DataFrame, list[Rule]]:
    """Add one marker column per drift check; returns the rules that read them.
    ``found`` holds the drifting ids (role, id) if they are known and stored."""
    if not drift:
        return df, []
    if found is None:
        found = store(drifting_ids(df, drift, across_roles), "drift")
    size = measured_bytes(found)
    if size == 0:
        return df, [Rule(d.name, F.lit(False)) for d in drift]
    rules = []
    for d in drift:
        marker = f"_{d.name}"
        role = "any" if across_roles else d.name
        ids = found.where(F.col("role") == role).select(
            F.col("id").alias(d.id_column), F.lit(True).alias(marker)
        )
        df = lookup_join(df, ids, [d.id_column], size=size)
        rules.append(Rule(d.name, F.col(marker)))
    return df, rules


MASK_BITS = 62  #: rules of one mask


def with_masks(df: DataFrame, rules: list[Rule], mask: str = "_failed") -> tuple[DataFrame, list[Rule]]:
    """Add the outcome of rules as bits of numbers; returns the rules that read them. So a
    row is judged once, what rules share is computed once, and a join or filter behind
    does not evaluate the rules again."""
    masks, judged = {}, []
    for at in range(0, len(rules), MASK_BITS):
        name = f"{mask}{at // MASK_BITS}"
        bits = [(rule, F.lit(1 << k).cast("bigint")) for k, rule in enumerate(rules[at : at + MASK_BITS])]
        masks[name] = reduce(lambda a, b: a.bitwiseOR(b), (F.when(rule.failing, bit).otherwise(F.lit(0).cast("bigint")) for rule, bit in bits))
        judged += [Rule(rule.name, F.col(name).bitwiseAND(bit) != 0) for rule, bit in bits]
    return df.withColumns(masks), judged


def any_failing(rules: list[Rule]) -> Column:
    return reduce(or_, (F.coalesce(r.failing, F.lit(False)) for r in rules))


def failing_names(rules: list[Rule]) -> Column:
    """Names of the rules a row fails, as an array in rule order."""
    if any("," in r.name for r in rules):
        raise ValueError("a rule name must not hold a comma")
    names = F.concat_ws(",", *[F.when(r.failing, F.lit(r.name)) for r in rules])
    return F.array_remove(F.split(names, ","), "")
