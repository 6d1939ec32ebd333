"""Repair of quarantined trips: a missing station id is replaced by the nearest
known station within a radius, with flags that tell inferred from measured ids;
repaired trips that break no other rule go back to silver."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.scalars import share_percent
from ridestrata.functions.timezones import LOCAL_TZ
from ridestrata.operators.conform import conform, silver_mapping
from ridestrata.operators.radius import RadiusIndex
from ridestrata.operators.snap import StationIndex
from ridestrata.operators.stored import lookup_join, store

SNAP_METRES = 50


@dataclass(frozen=True)
class Side:
    """One end of a trip."""

    name: str

    @property
    def station_id(self) -> str:
        return f"{self.name}_station_id"

    @property
    def station_name(self) -> str:
        return f"{self.name}_station_name"

    @property
    def lat(self) -> str:
        return f"{self.name}_lat"

    @property
    def lng(self) -> str:
        return f"{self.name}_lng"

    @property
    def repaired(self) -> str:
        return f"{self.name}_stn_id_repaired"

    @property
    def imputed(self) -> str:
        return f"{self.name}_stn_imputed"

    @property
    def metres(self) -> str:
        return f"{self.name}_snap_m"

    def lacks_station(self, key: str) -> Column:
        """The id is missing, the place is known, and the row has a key to be
        found by."""
        return (
            F.col(self.station_id).isNull()
            & F.col(self.lat).isNotNull()
            & F.col(self.lng).isNotNull()
            & F.col(key).isNotNull()
        )


SIDES = (Side("start"), Side("end"))


def lacking_points(bad: DataFrame, key: str = "ride_id", sides: tuple[Side, ...] = SIDES) -> DataFrame:
    """Places of all trip ends without a station, in one scan."""
    ends = F.array(
        *[
            F.struct(
                F.when(s.lacks_station(key), F.col(s.lat)).alias("lat"),
                F.when(s.lacks_station(key), F.col(s.lng)).alias("lng"),
            )
            for s in sides
        ]
    )
    return bad.select(F.inline(ends)).where("lat is not null")


def snap_to_nearest(
    bad: DataFrame,
    dim: DataFrame,
    side: Side,
    key: str = "ride_id",
    index: StationIndex | None = None,
) -> DataFrame:
    """Add ``{side}_near_stn`` and ``{side}_snap_m``, the nearest station at any
    distance, to the rows that lack this side's station."""
    if index is None:
        index = StationIndex(lacking_points(bad, key, (side,)), dim)
    return index.with_nearest(
        bad, side.lat, side.lng, side.lacks_station(key), f"{side.name}_near_stn", side.metres
    )


def snap_within(
    bad: DataFrame, dim: DataFrame, side: Side, max_m: float = SNAP_METRES, key: str = "ride_id"
) -> DataFrame:
    """``snap_to_nearest`` for stations at most ``max_m`` whole metres away, by a radius
    join alone; rows without such a station get NULL."""
    index = RadiusIndex(lacking_points(bad, key, (side,)), dim, max_m)
    return index.with_nearest(
        bad, side.lat, side.lng, side.lacks_station(key), f"{side.name}_near_stn", side.metres
    )


def repair_candidates(
    bad: DataFrame,
    dim: DataFrame,
    max_m: float = SNAP_METRES,
    key: str = "ride_id",
    sides: tuple[Side, ...] = SIDES,
) -> DataFrame:
    """Quarantined rows with at least one end snapped to a station at any
    distance; ids are replaced where the rounded distance is within ``max_m``.

    Every row is repaired on its own, so several rows with one key do not
    multiply.
    """
    columns = bad.columns
    index = StationIndex(lacking_points(bad, key, sides), dim)
    for side in sides:
        bad = snap_to_nearest(bad, dim, side, key, index)
    computed = {}
    for side in sides:
        near = F.col(side.metres) <= max_m
        snapped = F.when(near, F.col(f"{side.name}_near_stn").cast("double"))
        computed[side.repaired] = F.coalesce(F.col(side.station_id), snapped)
    for side in sides:
        inferred = F.col(side.station_id).isNull() & (F.col(side.metres) <= max_m)
        computed[side.imputed] = F.coalesce(inferred, F.lit(False))
    found = reduce(lambda a, b: a | b, (F.col(s.metres).isNotNull() for s in sides))
    return bad.where(found).select(
        *columns,
        *[value.alias(name) for name, value in computed.items()],
        *[s.metres for s in sides],
    )


def open_failures(sides: tuple[Side, ...] = SIDES) -> Column:
    """The failed rules that the repair of a row did not settle."""
    left = F.col("failed_rules")
    for side in sides:
        settled = F.array(
            F.lit(f"missing_{side.station_id}"), F.lit(f"missing_{side.station_name}")
        )
        left = F.when(F.col(side.imputed), F.array_except(left, settled)).otherwise(left)
    return left


def recovered(candidates: DataFrame, sides: tuple[Side, ...] = SIDES) -> DataFrame:
    """Candidates that break no rule any more."""
    return candidates.where(F.size(open_failures(sides)) == 0)


def merge_repaired(
    silver: DataFrame,
    candidates: DataFrame,
    dim: DataFrame,
    tz: str = LOCAL_TZ,
    sides: tuple[Side, ...] = SIDES,
) -> DataFrame:
    """Silver plus the recovered rows, with ``{side}_stn_imputed`` flags. The name
    of an inferred station comes from the station table."""
    rows = recovered(candidates, sides)
    names = store(dim.select("stn_id", "stn_name"), "station-names")
    for side in sides:
        key, name = f"_{side.name}_stn", f"_{side.name}_stn_name"
        rows = rows.withColumn(
            key, F.when(F.col(side.imputed), F.col(side.repaired).cast("int"))
        )
        rows = lookup_join(rows, names.toDF(key, name), [key])
        rows = rows.withColumns(
            {
                side.station_id: F.col(side.repaired),
                side.station_name: F.when(F.col(side.imputed), F.col(name)).otherwise(
                    F.col(side.station_name)
                ),
            }
        )
    flags = {s.imputed: F.col(s.imputed) for s in sides}
    repaired = conform(rows, {**silver_mapping(tz), **flags})
    measured = silver.withColumns({s.imputed: F.lit(False) for s in sides})
    return measured.unionByName(repaired)


def recovery_summary(
    flagged: DataFrame, candidates: DataFrame, sides: tuple[Side, ...] = SIDES
) -> DataFrame:
    """Shares, in percent: quarantined of all rows; recovered and unusable of the
    quarantined rows."""
    repaired = candidates.agg(F.count_if(F.size(open_failures(sides)) == 0))
    counts = flagged.agg(
        F.count("*").alias("total"), F.count_if("is_bad").alias("quarantined")
    ).withColumn("recovered", repaired.scalar())
    lost = F.col("quarantined") - F.col("recovered")
    return counts.select(
        "total",
        "quarantined",
        "recovered",
        lost.alias("unusable"),
        share_percent(F.col("quarantined"), F.col("total"), 1).alias("quarantined_pct"),
        share_percent(F.col("recovered"), F.col("quarantined"), 1).alias("recovered_pct"),
        share_percent(lost, F.col("quarantined"), 1).alias("unusable_pct"),
    )
