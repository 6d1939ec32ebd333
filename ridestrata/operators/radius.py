"""Nearest point within a radius, by cells as wide as the radius.

A row lies in one cell, and whatever is within the radius lies in that cell or one of its
eight neighbours. So every station is listed in the nine cells around it, and rows meet
the list of their cell in an equi-join. A crowded cell, one with a long list, is cut into
finer cells, and each of these lists only the stations that can be nearest to some place
in it. Rows are not shuffled while the lists are small; beyond that, hot cells are spread.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.functions.scalars import rounded
from ridestrata.functions.spatial import LNG_SCALE, METRES_PER_DEGREE, planar_distance_m
from ridestrata.operators.stored import lookup_join, measured_bytes, store

LONG_LIST = 64
CUT = 8  #: a crowded cell is cut into CUT * CUT cells
DEPTH = 3  #: how often
FARTHEST = 1 << 50  #: cell numbers are whole up to here; beyond, cells are as good as one
SLACK = 1 + 1e-9  #: distances of cells are rounded this much to the safe side


def _cells(lat: Column, lng: Column, edge: float, lng_scale: float) -> list[Column]:
    """Cell numbers of a place; NULL where it has none."""

    def number(value: Column) -> Column:
        bounded = F.greatest(F.least(value / F.lit(edge), F.lit(float(FARTHEST))), F.lit(-float(FARTHEST)))
        return F.when(~F.isnan(value), F.floor(bounded))

    return [number(lat), number(lng * F.lit(lng_scale))]


def _span(cell: Column, place: Column, edge: float) -> tuple[Column, Column]:
    """Least and greatest distance of a coordinate to the points of a cell."""
    low, high = cell * F.lit(edge), (cell + 1) * F.lit(edge)
    return F.greatest(F.lit(0.0), low - place, place - high), F.greatest(F.abs(place - low), F.abs(high - place))


class RadiusIndex:
    """Lists of stations by cell, for the places of ``points`` (lat, lng).

    ``dim`` is a station table (stn_id, lat, lng); of stations at one and the same place
    the smallest id stands for all. Places with a missing or NaN coordinate have no
    neighbour."""

    def __init__(
        self, points: DataFrame, dim: DataFrame, metres: float, lng_scale: float = LNG_SCALE, long_list: int = LONG_LIST
    ):
        self.metres, self.lng_scale = metres, lng_scale
        self.degrees = (metres + 0.5) / METRES_PER_DEGREE  # whole metres are compared
        lat, lng = F.col("lat"), F.col("lng")
        placed = dim.select("stn_id", lat.cast("double").alias("lat"), lng.cast("double").alias("lng")).dropna()
        placed = placed.where(~F.isnan("lat") & ~F.isnan("lng")).groupBy("lat", "lng").agg(F.min("stn_id").alias("stn_id"))
        # Of places far beyond any map, coordinates are coarser than a cell; one list serves.
        edge = self.degrees * SLACK
        around = F.sequence(F.lit(-1), F.lit(1))
        cx, cy = _cells(lat, lng, edge, lng_scale)
        found = placed.withColumns({"cx": cx, "cy": cy}).withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
        found = found.selectExpr("cx + dx AS cx", "cy + dy AS cy", "stn_id", "lat", "lng")
        self.parts: list[tuple[float, DataFrame, int]] = []
        for depth in range(DEPTH + 1):
            found = store(found, "stations-by-cell")
            crowded = None
            if depth < DEPTH:
                longer = found.groupBy("cx", "cy").count().where(F.col("count") > long_list).select("cx", "cy")
                if not longer.isEmpty():
                    crowded = store(longer, "crowded-cells")
            short = found if crowded is None else found.join(crowded, ["cx", "cy"], "left_anti")
            lists = short.groupBy("cx", "cy").agg(F.collect_list(F.struct("lat", "lng", "stn_id")).alias("stations"))
            lists = store(lists, "station-lists")
            self.parts.append((edge, lists, measured_bytes(lists)))
            if crowded is None:
                break
            found, edge = self._finer(points, found, crowded, edge), edge / CUT

    def _finer(self, points: DataFrame, found: DataFrame, crowded: DataFrame, edge: float) -> DataFrame:
        """The occupied finer cells of crowded ones, each with the stations of its crowded
        cell that are within the radius and can be nearest."""
        lat, lng, fine = F.col("lat"), F.col("lng"), edge / CUT
        (ax, ay), (bx, by) = (_cells(lat, lng, e, self.lng_scale) for e in (edge, fine))
        places = points.select(ax.alias("cx"), ay.alias("cy"), bx.alias("fx"), by.alias("fy"))
        occupied = lookup_join(places.dropna(), crowded, ["cx", "cy"], "left_semi").distinct()
        pairs = occupied.join(found.join(crowded, ["cx", "cy"], "left_semi"), ["cx", "cy"])
        (near_x, far_x), (near_y, far_y) = _span(F.col("fx"), lat, fine), _span(F.col("fy"), lng * F.lit(self.lng_scale), fine)
        near, far = F.hypot(near_x, near_y), F.hypot(far_x, far_y)
        spanned = pairs.withColumns({"near": near, "far": far}).where(F.col("near") <= F.lit(self.degrees * SLACK))
        reach = spanned.groupBy("fx", "fy").agg((F.min("far") * F.lit(SLACK) + F.lit(1e-12)).alias("reach"))
        kept = spanned.join(reach, ["fx", "fy"]).where("near <= reach")
        return kept.select(F.col("fx").alias("cx"), F.col("fy").alias("cy"), "stn_id", "lat", "lng")

    def with_nearest(self, df: DataFrame, lat: str, lng: str, wanted: Column, stn_id: str, metres: str) -> DataFrame:
        """Add the nearest station within the radius and its distance in whole metres to
        the rows for which ``wanted`` is true; NULL where there is none. Of equally near
        stations the smallest id is taken."""
        columns, lists = df.columns, []
        for number, (edge, table, size) in enumerate(self.parts):
            keys = [f"_cx{number}", f"_cy{number}"]
            for key, cell in zip(keys, _cells(F.col(lat), F.col(lng), edge, self.lng_scale)):
                df = df.withColumn(key, F.when(wanted, cell))
            lists.append(f"_stations{number}")
            df = lookup_join(df, table.toDF(*keys, lists[-1]), keys, size=size)

        def measured(station: Column) -> Column:
            return planar_distance_m(F.col(lat), F.col(lng), station["lat"], station["lng"], self.lng_scale, 1)

        structs = F.transform(F.coalesce(*lists), lambda s: F.struct(measured(s).alias("dist"), s["stn_id"].alias("stn_id")))
        df = df.withColumn("_nearest", F.array_min(structs))
        whole = rounded(F.col("_nearest.dist") * METRES_PER_DEGREE, 0)
        near = F.col("_nearest.dist") <= F.lit(self.degrees * SLACK)
        df = df.withColumn("_metres", F.when(near, whole))
        inside = F.col("_metres") <= F.lit(self.metres)
        return df.select(
            *columns, F.when(inside, F.col("_nearest.stn_id")).alias(stn_id), F.when(inside, F.col("_metres")).alias(metres)
        )
