"""Map coordinates as Column arithmetic: transverse Mercator by Krueger's series, spherical Mercator.

Series to the fourth order in the third flattening: below a micrometre of error within a zone. NULL and non-finite input gives NULL or NaN.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from geocadence.functions.geo import once
from geocadence.model import MERCATOR_RADIUS_M

# fixed values: semi-major axis (m) and inverse flattening
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)


@dataclass(frozen=True)
class TransverseMercator:
    """One zone: central meridian (degrees), scale on it and false origin (m)."""

    lon0: float
    k0: float = 0.9996
    east0: float = 500000.0
    north0: float = 0.0
    ellipsoid: tuple[float, float] = WGS84

    @property
    def _n(self) -> float:
        return 1 / (2 * self.ellipsoid[1] - 1)  # third flattening

    @property
    def _radius(self) -> float:
        n = self._n
        return self.k0 * self.ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(x, y) in metres of a place in degrees."""
        n = self._n
        # fixed values: coefficients of the series
        alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
                 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
        e = 2 * math.sqrt(n) / (1 + n)  # eccentricity
        s, away = F.sin(F.radians(lat)), F.radians(lon - F.lit(self.lon0))
        t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
        xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
        x = reduce(add, [F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(alpha, 1)], eta)
        y = reduce(add, [F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(alpha, 1)], xi)
        return F.lit(self.east0) + F.lit(self._radius) * x, F.lit(self.north0) + F.lit(self._radius) * y

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(lon, lat) in degrees of a place in metres."""
        n = self._n
        # fixed values: coefficients of the series
        beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
                17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
        delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
                 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
        xi, eta = (y - F.lit(self.north0)) / F.lit(self._radius), (x - F.lit(self.east0)) / F.lit(self._radius)
        xi1 = reduce(add, [F.lit(-b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(beta, 1)], xi)
        eta1 = reduce(add, [F.lit(-b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(beta, 1)], eta)
        lat = once(F.asin(F.sin(xi1) / F.cosh(eta1)), lambda chi: reduce(add, [F.lit(d) * F.sin(2 * j * chi) for j, d in enumerate(delta, 1)], chi))
        return F.lit(self.lon0) + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(lat)


@dataclass(frozen=True)
class SphericalMercator:
    """Web Mercator."""

    radius: float = MERCATOR_RADIUS_M

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        return F.radians(lon) * F.lit(self.radius), F.atanh(F.sin(F.radians(lat))) * F.lit(self.radius)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.degrees(x / F.lit(self.radius)), F.degrees(F.atan(F.sinh(y / F.lit(self.radius))))


def projection(epsg: int) -> TransverseMercator | SphericalMercator | None:
    """The projection of a code; None for plain degrees.

    Known: 4326 and 4258 (degrees), 3857, UTM on WGS 84 (32601-32660 north, 32701-32760 south) and on ETRS89
    (25828-25838). Systems on other datums need a shift of datum and are refused.
    """
    meridian = lambda zone: 6.0 * zone - 183.0
    if epsg in (4326, 4258):
        return None
    if epsg == 3857:
        return SphericalMercator()
    if 32601 <= epsg <= 32660:
        return TransverseMercator(meridian(epsg - 32600))
    if 32701 <= epsg <= 32760:
        return TransverseMercator(meridian(epsg - 32700), north0=10000000.0)
    if 25828 <= epsg <= 25838:
        return TransverseMercator(meridian(epsg - 25800), ellipsoid=GRS80)
    raise ValueError(f"unknown coordinate system {epsg}")
