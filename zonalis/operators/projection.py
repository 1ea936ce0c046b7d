"""Map projections as steps of column expressions: transverse Mercator and cylindrical equal-area.

Series in the third flattening ``n`` after Krueger, to fourth order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# A coordinate function: two columns to two columns. A projection is a list of them.
Step = Callable[[Column, Column], tuple[Column, Column]]

# Published ellipsoid and zone parameters.
GRS80 = (6378137.0, 298.257222101)
WGS84 = (6378137.0, 298.257223563)
AIRY1830 = (6377563.396, 299.3249646)


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    lat0: float = -90.0
    scale: float = 1.0
    false_easting: float = 0.0
    false_northing: float = 0.0
    ellipsoid: tuple[float, float] = GRS80

    @property
    def n(self) -> float:
        f = 1 / self.ellipsoid[1]
        return f / (2 - f)

    @property
    def radius(self) -> float:
        """Rectifying radius times the scale on the central meridian."""
        n = self.n
        return self.scale * self.ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def alpha(self) -> list[float]:
        """Conformal sphere to plane."""
        n = self.n
        return [
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        ]

    @property
    def beta(self) -> list[float]:
        """Plane to conformal sphere."""
        n = self.n
        return [
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        ]

    @property
    def delta(self) -> list[float]:
        """Conformal to geodetic latitude."""
        n = self.n
        return [
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
            7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35,
            4279 * n**4 / 630,
        ]

    @property
    def eccentricity(self) -> float:
        return 2 * math.sqrt(self.n) / (1 + self.n)

    @property
    def origin(self) -> float:
        """Series value at the latitude of origin."""
        if abs(self.lat0) == 90:
            return math.copysign(math.pi / 2, self.lat0)
        s, e = math.sin(math.radians(self.lat0)), self.eccentricity
        xi = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
        return xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(self.alpha, 1))

    @property
    def forward(self) -> list[Step]:
        """Degrees to easting and northing."""
        e = self.eccentricity

        def conformal(lon: Column, lat: Column) -> tuple[Column, Column]:
            s = F.sin(F.radians(lat))
            return F.radians(lon - self.lon0), F.sinh(F.atanh(s) - F.atanh(s * e) * e)

        def spherical(dlon: Column, t: Column) -> tuple[Column, Column]:
            return F.atanh(F.sin(dlon) / F.sqrt(t * t + 1)), F.atan2(t, F.cos(dlon))

        def metres(eta: Column, xi: Column) -> tuple[Column, Column]:
            east, north = eta, xi
            for j, a in enumerate(self.alpha, 1):
                east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
                north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
            return east * self.radius + self.false_easting, (north - self.origin) * self.radius + self.false_northing

        return [conformal, spherical, metres]

    @property
    def inverse(self) -> list[Step]:
        """Easting and northing to degrees."""

        def scaled(east: Column, north: Column) -> tuple[Column, Column]:
            return (east - self.false_easting) / self.radius, (north - self.false_northing) / self.radius + self.origin

        def spherical(eta: Column, xi: Column) -> tuple[Column, Column]:
            eta1, xi1 = eta, xi
            for j, b in enumerate(self.beta, 1):
                eta1 = eta1 - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b
                xi1 = xi1 - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b
            return eta1, xi1

        def conformal(eta: Column, xi: Column) -> tuple[Column, Column]:
            return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + self.lon0, F.asin(F.sin(xi) / F.cosh(eta))

        def degrees(lon: Column, chi: Column) -> tuple[Column, Column]:
            lat = chi
            for j, d in enumerate(self.delta, 1):
                lat = lat + F.sin(chi * (2 * j)) * d
            return lon, F.degrees(lat)

        return [scaled, spherical, conformal, degrees]


# Zone of the census layers: central meridian 66 W, false easting 3,500,000.
CENSUS_ZONE = TransverseMercator(lon0=-66.0, false_easting=3_500_000.0)


def equal_area(ellipsoid: tuple[float, float] = WGS84) -> list[Step]:
    """Degrees to a cylindrical equal-area plane in metres; areas there are areas on the ellipsoid."""
    a, inverse_f = ellipsoid
    e = math.sqrt((2 - 1 / inverse_f) / inverse_f)

    def sine(lon: Column, lat: Column) -> tuple[Column, Column]:
        return F.radians(lon) * a, F.sin(F.radians(lat))

    def authalic(x: Column, s: Column) -> tuple[Column, Column]:
        q = (s / (F.lit(1.0) - s * s * (e * e)) + F.atanh(s * e) / e) * (1 - e * e)
        return x, q * (a / 2)

    return [sine, authalic]


def move(x: Column, y: Column, steps: Sequence[Step]) -> tuple[Column, Column]:
    """One coordinate pair through all steps."""
    for step in steps:
        x, y = step(x, y)
    return x, y


def map_vertices(rings: Column, steps: Sequence[Step]) -> Column:
    """Every vertex through all steps.

    Each step is a pass of its own over the vertices: its inputs are values then, and an expression that
    uses them several times does not repeat the steps before it.
    """

    def over_vertices(step: Step) -> Callable[[Column], Column]:
        def moved(p: Column) -> Column:
            x, y = step(p["x"], p["y"])
            return F.struct(x.alias("x"), y.alias("y"))

        return lambda ring: F.transform(ring, moved)

    for step in steps:
        rings = F.transform(rings, over_vertices(step))
    return rings
