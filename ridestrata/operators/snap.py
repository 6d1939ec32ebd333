"""Nearest known station per row, exact, without comparing every pair.

Rows are not matched with stations directly. The occupied grid cells of the rows
(far fewer than the rows) descend a nested grid together with the cells of the
stations; at every level a station cell is dropped when even its nearest corner
is farther from the row cell than the farthest corner of another station cell.
What is left per row cell is the short list of stations that can be nearest to
some point of that cell, and each row takes the minimum over its cell's list.
Cells are numbered by whole numbers and their distances are rounded to the safe side,
so no rounding can drop the right station.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.scalars import rounded
from ridestrata.functions.spatial import (
    LNG_SCALE,
    METRES_PER_DEGREE,
    PLACES,
    Grid,
    planar_distance_m,
)
from ridestrata.operators.stored import lookup_join, measured_bytes, store

# Row cells have edges of 1/512 degree (about 220 m). The descent from the top
# takes three levels at a time: a cell then meets at most 64 children of each of
# the few cells that are near its parent.
LEAF_LEVEL = -9
STEP = 3
STARTS = (10, 19, 28)  #: levels at which the descent may begin
START_PAIRS = 4096
# A row cell with more stations than LONG_LIST is cut into cells of the next
# level; the last has edges of 0.8 m.
FINER_LEVELS = (-13, -17)
LONG_LIST = 64


def _cell_of(df: DataFrame, grid: Grid, level: int, lat: str, lng: str) -> DataFrame:
    cx, cy = grid.index(F.col(lat), F.col(lng), level)
    return df.select(cx.alias("cx"), cy.alias("cy"))


def _spanned(pairs: DataFrame, row_edge: int, station_edge: int) -> DataFrame:
    """Add ``near`` and ``far``: squared distances of the nearest and farthest
    points of a row cell (cx, cy) and a station cell (sx, sy), given their edges. Gaps
    are whole; their squares may be rounded, so ``far`` is a little too large."""
    gaps = []
    for axis in ("x", "y"):
        row, station = f"c{axis} * {row_edge}L", f"s{axis} * {station_edge}L"
        gaps += [
            f"double(greatest(0L, {row} - {station} - {station_edge}L, {station} - {row} - {row_edge}L))"
            f" AS near_{axis}",
            f"double(greatest({row} + {row_edge}L - {station}, {station} + {station_edge}L - {row}))"
            f" AS far_{axis}",
        ]
    return pairs.selectExpr("*", *gaps).selectExpr(
        *pairs.columns,
        "near_x * near_x + near_y * near_y AS near",
        "(far_x * far_x + far_y * far_y) * 1.000000000001D AS far",
    )


def _up(x: str, y: str, steps: int, x_name: str, y_name: str) -> list[str]:
    """The cell's indices ``steps`` levels up, as select expressions."""
    return [f"shiftright({x}, {steps}) AS {x_name}", f"shiftright({y}, {steps}) AS {y_name}"]


def _start(row_cells: DataFrame, stations: DataFrame, grid: Grid, leaf: int) -> int:
    """The level to begin at: low enough to save steps, with few cells on both sides."""

    def cells(level: int):
        rows = F.struct(F.shiftright("cx", level - leaf), F.shiftright("cy", level - leaf))
        return F.count_distinct(rows).alias(f"n{level}")

    def station_cells(level: int):
        found = F.struct(F.shiftright("sx", level - grid.finest), F.shiftright("sy", level - grid.finest))
        return F.count_distinct(found).alias(f"n{level}")

    rows = row_cells.agg(*map(cells, STARTS)).first()
    placed = stations.agg(*map(station_cells, STARTS)).first()
    small = [level for level in STARTS if rows[f"n{level}"] * placed[f"n{level}"] <= START_PAIRS]
    return small[0] if small else grid.root


def _descend(row_cells: DataFrame, stations: DataFrame, grid: Grid, leaf: int) -> DataFrame:
    """(cx, cy, stn_id, lat, lng): for every row cell of level ``leaf`` the
    stations that may be nearest to a point in it."""
    levels = [*range(_start(row_cells, stations, grid, leaf), leaf, -STEP), leaf]
    frontier = None
    for above, level in zip([None, *levels], levels):
        rows = row_cells.selectExpr(*_up("cx", "cy", level - leaf, "cx", "cy")).distinct()
        cells = stations.selectExpr(*_up("sx", "sy", level - grid.finest, "sx", "sy")).distinct()
        if frontier is None:
            # At most START_PAIRS pairs, or the four cells around the origin on each side.
            pairs = rows.withColumn("_all", F.lit(0)).join(cells.withColumn("_all", F.lit(0)), "_all")
        else:
            step = above - level
            pairs = (
                frontier.toDF("px", "py", "qx", "qy")
                .join(rows.selectExpr("*", *_up("cx", "cy", step, "px", "py")), ["px", "py"])
                .join(cells.selectExpr("*", *_up("sx", "sy", step, "qx", "qy")), ["qx", "qy"])
            )
        # A row cell meets a bounded number of station cells at each level.
        frontier = (
            _spanned(pairs.select("cx", "cy", "sx", "sy"), 1, 1)
            .selectExpr("*", "min(far) OVER (PARTITION BY cx, cy) AS reach")
            .where("near <= reach")
            .select("cx", "cy", "sx", "sy")
        )
    frontier = store(frontier, "near-cells").toDF("cx", "cy", "lx", "ly")
    up = leaf - grid.finest
    located = stations.selectExpr("*", *_up("sx", "sy", up, "lx", "ly"))
    spanned = _spanned(frontier.join(located, ["lx", "ly"]), 1 << up, 1)
    reach = spanned.groupBy("cx", "cy").agg(F.min("far").alias("reach"))
    kept = spanned.join(reach, ["cx", "cy"]).where("near <= reach")
    return kept.select("cx", "cy", "stn_id", "lat", "lng")


def _lists(found: DataFrame) -> DataFrame:
    station = F.struct("lat", "lng", "stn_id")
    return found.groupBy("cx", "cy").agg(F.collect_list(station).alias("stations"))


class StationIndex:
    """Short lists of possibly nearest stations, per occupied cell of ``points``.

    ``points`` has the columns lat and lng (DOUBLE) of all rows to be snapped;
    ``dim`` is a station table (stn_id, lat, lng). Of stations at one and the same
    place the smallest id stands for all. Places beyond every map are as good as others
    up to eight thousand million degrees; above, a place counts as unknown.
    """

    def __init__(self, points: DataFrame, dim: DataFrame, long_list: int = LONG_LIST):
        lat, lng = F.col("lat"), F.col("lng")
        placed = dim.select("stn_id", lat.cast("double").alias("lat"), lng.cast("double").alias("lng"))
        placed = placed.where(PLACES.holds(lat, lng)).groupBy("lat", "lng").agg(F.min("stn_id").alias("stn_id"))
        self.parts: list[tuple[int, DataFrame, int]] = []
        points = store(points.where(PLACES.holds(lat, lng)).distinct(), "points")
        self._add(PLACES, points, store(placed, "stations"), (LEAF_LEVEL, *FINER_LEVELS), long_list)

    def _add(
        self, grid: Grid, points: DataFrame, stations: DataFrame, levels: tuple[int, ...], long_list: int
    ) -> None:
        sx, sy = grid.index(F.col("lat"), F.col("lng"), grid.finest)
        stations = stations.withColumns({"sx": sx, "sy": sy})
        for level in levels:
            cells = store(_cell_of(points, grid, level, "lat", "lng").distinct(), "row-cells")
            found = store(_descend(cells, stations, grid, level), "near-stations")
            crowded = None
            if level != levels[-1]:
                longer = found.groupBy("cx", "cy").count().where(F.col("count") > long_list)
                if not longer.isEmpty():
                    crowded = store(longer.select("cx", "cy"), "crowded-cells")
            short = found if crowded is None else found.join(crowded, ["cx", "cy"], "left_anti")
            lists = store(_lists(short), "station-lists")
            self.parts.append((level, lists, measured_bytes(lists)))
            if crowded is None:
                break
            cx, cy = grid.index(F.col("lat"), F.col("lng"), level)
            points = lookup_join(
                points.withColumns({"cx": cx, "cy": cy}), crowded, ["cx", "cy"], "left_semi"
            ).select("lat", "lng")

    def with_nearest(
        self, df: DataFrame, lat: str, lng: str, wanted: Column, stn_id: str, metres: str
    ) -> DataFrame:
        """Add the nearest station and its distance in whole metres to the rows
        for which ``wanted`` is true; NULL in the others. Of equally near
        stations the smallest id is taken."""
        columns = df.columns
        place = F.col(lat), F.col(lng)
        asked, lists = wanted & PLACES.holds(*place), []
        for number, (level, table, size) in enumerate(self.parts):
            keys = [f"_cx{number}", f"_cy{number}"]
            for key, index in zip(keys, PLACES.index(*place, level)):
                df = df.withColumn(key, F.when(asked, index))
            lists.append(f"_stations{number}")
            df = lookup_join(df, table.toDF(*keys, lists[-1]), keys, size=size)
        degrees = lambda s: planar_distance_m(
            F.col(lat), F.col(lng), s["lat"], s["lng"], LNG_SCALE, 1
        )
        nearest = F.array_min(
            F.transform(
                F.coalesce(*lists),
                lambda s: F.struct(degrees(s).alias("dist"), s["stn_id"].alias("stn_id")),
            )
        )
        df = df.withColumn("_nearest", nearest)
        whole = rounded(F.col("_nearest.dist") * METRES_PER_DEGREE, 0)
        return df.select(
            *columns, F.col("_nearest.stn_id").alias(stn_id), whole.alias(metres)
        )
