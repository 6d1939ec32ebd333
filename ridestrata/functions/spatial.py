"""Planar distance and the nested square grids used to find nearest points.

Coordinates are flattened to x = latitude, y = longitude * lng_scale, so the
planar distance is Euclidean in (x, y). A cell of level k has an edge of 2**k
degrees, and the cell of a point at a coarser level is its index shifted to the right.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LNG_SCALE = 0.778
METRES_PER_DEGREE = 111_000


def planar_distance_m(
    lat1: Column,
    lng1: Column,
    lat2: Column,
    lng2: Column,
    lng_scale: float = LNG_SCALE,
    m_per_deg: float = METRES_PER_DEGREE,
) -> Column:
    """Straight-line metres between two points of one metropolitan area."""
    dx = lat1 - lat2
    dy = (lng1 - lng2) * F.lit(lng_scale)
    return F.sqrt(F.pow(dx, F.lit(2)) + F.pow(dy, F.lit(2))) * F.lit(m_per_deg)


@dataclass(frozen=True)
class Grid:
    """Levels ``root`` to ``finest``, at most 52 levels apart, so that cell indices and
    their scaled coordinates are exact in a DOUBLE."""

    root: int
    finest: int

    def holds(self, lat: Column, lng: Column, lng_scale: float = LNG_SCALE) -> Column:
        """False for NaN, NULL for NULL."""
        edge = 2.0 ** (self.root - 1)
        inside = lambda v: (v >= F.lit(-edge)) & (v < F.lit(edge))
        return inside(lat) & inside(lng * F.lit(lng_scale))

    def index(
        self, lat: Column, lng: Column, level: int, lng_scale: float = LNG_SCALE
    ) -> tuple[Column, Column]:
        """Cell indices of a point at a level, nested exactly across levels."""
        fine, half = 2.0**-self.finest, 1 << (self.root - 1 - self.finest)
        ix = F.floor(lat * F.lit(fine)) + F.lit(half)
        iy = F.floor(lng * F.lit(lng_scale) * F.lit(fine)) + F.lit(half)
        step = level - self.finest
        return coarser(ix, step), coarser(iy, step)


# Holds every place on earth, and mistyped ones up to eight thousand million degrees.
PLACES = Grid(root=34, finest=-18)


def coarser(index: Column, steps: int) -> Column:
    return F.shiftright(index, steps) if steps else index
