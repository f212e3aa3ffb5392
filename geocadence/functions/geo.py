"""Geometry as Column arithmetic: great-circle distance, Mercator, ray casting, grid indices."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from geocadence.model import EARTH_RADIUS_M, MERCATOR_RADIUS_M


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda's argument is one, an expression that is named twice is computed twice."""
    return F.element_at(F.transform(F.array(value), use), 1)


@dataclass(frozen=True)
class Grid:
    """Regular lon/lat grid, north-up: row 0 is the northernmost row."""

    nrows: int
    ncols: int
    xll: float
    yll: float
    cellsize: float

    @property
    def lon0(self) -> float:
        return self.xll + self.cellsize / 2

    @property
    def lat0(self) -> float:
        """Latitude of row 0."""
        return self.yll + self.cellsize / 2 + self.cellsize * (self.nrows - 1)

    def lon(self, col: Column) -> Column:
        return F.lit(self.lon0) + col * F.lit(self.cellsize)

    def lat(self, row: Column) -> Column:
        return F.lit(self.lat0) - row * F.lit(self.cellsize)

    def col_pos(self, lon: Column) -> Column:
        """Fractional column of a longitude (0 = centre of the first column)."""
        return (lon - F.lit(self.lon0)) / F.lit(self.cellsize)

    def row_pos(self, lat: Column) -> Column:
        return (F.lit(self.lat0) - lat) / F.lit(self.cellsize)

    @property
    def metres_per_row(self) -> float:
        return math.radians(self.cellsize) * EARTH_RADIUS_M

    def least_metres_per_col(self) -> float:
        worst = max(abs(self.yll), abs(self.yll + self.nrows * self.cellsize))
        return self.metres_per_row * max(math.cos(math.radians(min(worst, 89.9))), 1e-3)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * MERCATOR_RADIUS_M


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS_M


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / MERCATOR_RADIUS_M)


def mercator_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / MERCATOR_RADIUS_M)) * 2 - F.lit(math.pi / 2))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring given as array<struct<x,y>>; the ring is closed when it is not already."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(ring, following, lambda p, q: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))


def polygon_rings(columns: list[str]) -> Column:
    """All rings of a polygon table: outlines and holes of every part in ``rings``, or the single ``ring``."""
    return F.col("rings") if "rings" in columns else F.array("ring")


def polygon_edges(rings: Column) -> Column:
    """Edges of all rings. With the even-odd rule a hole is outside and a second part inside."""
    return F.flatten(F.transform(rings, ring_edges))


def crosses(e: Column, y: Column) -> Column:
    """Whether the horizontal line at y passes between the ends of an edge."""
    return (e["y1"] > y) != (e["y2"] > y)


def cross_x(e: Column, y: Column) -> Column:
    """Where it does so."""
    return e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])


def on_edge(edges: Column, x: Column, y: Column) -> Column:
    """True when the point lies exactly on an edge (such points are not ``within``)."""
    def touches(e):
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            (cross == 0)
            & (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
            & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
        )
    return F.exists(edges, touches)


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Ray casting, boundary excluded."""
    odd = F.aggregate(
        edges, F.lit(False),
        lambda acc, e: acc != (crosses(e, y) & F.when(crosses(e, y), x < cross_x(e, y)).otherwise(False)),
    )
    return odd & ~on_edge(edges, x, y)
