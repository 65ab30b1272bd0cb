"""Ellipsoidal map projections as column expressions: Lambert conformal conic and transverse Mercator, both ways.

A system turns longitude and latitude in degrees into metres east and north. The constants that depend on the system alone
are worked out once on the driver; what is left for each row is a handful of JVM functions. The conic is the closed form
with two standard parallels; the transverse Mercator is the series in the third flattening up to its fourth power, which
is within a thousandth of a millimetre for some degrees around the central meridian.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from commuta.functions.geometry import mercator_x, mercator_y


@dataclass(frozen=True)
class Ellipsoid:
    """``a``: half the larger axis in metres; ``inverse_f``: 1 / flattening."""

    a: float
    inverse_f: float

    @property
    def e(self) -> float:
        f = 1 / self.inverse_f
        return math.sqrt(f * (2 - f))

    @property
    def n(self) -> float:
        """Third flattening."""
        return 1 / (2 * self.inverse_f - 1)


# The ellipsoid of the North American datum of 1983.
GRS80 = Ellipsoid(6378137.0, 298.257222101)


def _steps(value: Column, step, times: int) -> Column:
    for _ in range(times):
        value = step(value)
    return value


@dataclass(frozen=True)
class LambertConformal:
    """Lambert conformal conic with two standard parallels; angles in degrees, false origin in metres."""

    lat1: float
    lat2: float
    lat0: float
    lon0: float
    east0: float
    north0: float
    ellipsoid: Ellipsoid = GRS80

    def _t(self, lat: float) -> float:
        s = math.sin(lat)
        e = self.ellipsoid.e
        return math.tan(math.pi / 4 - lat / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)

    def _cone(self) -> tuple[float, float, float]:
        """The cone's exponent, the scale of its radii, and the radius of the false origin."""
        e = self.ellipsoid.e
        one, two, zero = (math.radians(x) for x in (self.lat1, self.lat2, self.lat0))
        m1, m2 = (math.cos(x) / math.sqrt(1 - (e * math.sin(x)) ** 2) for x in (one, two))
        n = math.log(m1 / m2) / math.log(self._t(one) / self._t(two)) if one != two else math.sin(one)
        scale = self.ellipsoid.a * m1 / (n * self._t(one) ** n)
        return n, scale, scale * self._t(zero) ** n

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, scale, radius0 = self._cone()
        e = self.ellipsoid.e
        phi = F.radians(lat)
        s = e * F.sin(phi)
        t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
        radius = scale * F.pow(t, F.lit(n))
        theta = n * F.radians(lon - self.lon0)
        return self.east0 + radius * F.sin(theta), self.north0 + radius0 - radius * F.cos(theta)

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        n, scale, radius0 = self._cone()
        e, sign = self.ellipsoid.e, math.copysign(1.0, n)
        east, north = (x - self.east0) * sign, (radius0 - (y - self.north0)) * sign
        t = F.pow(F.sqrt(east * east + north * north) / (scale * sign), F.lit(1 / n))

        def better(phi: Column) -> Column:
            s = e * F.sin(phi)
            return math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))

        phi = _steps(math.pi / 2 - 2 * F.atan(t), better, 6)
        return F.degrees(F.atan2(east, north) / n) + self.lon0, F.degrees(phi)


@dataclass(frozen=True)
class TransverseMercator:
    """Transverse Mercator; angles in degrees, false origin in metres."""

    lat0: float
    lon0: float
    scale: float
    east0: float
    north0: float
    ellipsoid: Ellipsoid = GRS80

    def _series(self) -> tuple[float, list[float], list[float]]:
        """The rectifying radius, and the series onto the plane and back."""
        n = self.ellipsoid.n
        radius = self.ellipsoid.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        onto = [
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        ]
        back = [
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        ]
        return self.scale * radius, onto, back

    def _origin(self) -> float:
        """Metres from the equator to the false origin along the central meridian."""
        radius, onto, _ = self._series()
        s, e = math.sin(math.radians(self.lat0)), self.ellipsoid.e
        xi = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
        return radius * (xi + sum(a * math.sin(2 * (k + 1) * xi) for k, a in enumerate(onto)))

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        radius, onto, _ = self._series()
        e = self.ellipsoid.e
        s = F.sin(F.radians(lat))
        t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
        away = F.radians(lon - self.lon0)
        xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
        x, y = eta, xi
        for k, a in enumerate(onto, 1):
            x = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
            y = y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        return self.east0 + radius * x, self.north0 - self._origin() + radius * y

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        radius, _, back = self._series()
        e = self.ellipsoid.e
        xi, eta = (y - self.north0 + self._origin()) / radius, (x - self.east0) / radius
        u, v = xi, eta
        for k, b in enumerate(back, 1):
            u = u - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
            v = v - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        conformal = F.asinh(F.sin(u) / F.sqrt(F.pow(F.sinh(v), F.lit(2.0)) + F.pow(F.cos(u), F.lit(2.0))))
        isometric = _steps(conformal, lambda q: conformal + e * F.atanh(e * F.tanh(q)), 6)
        return F.degrees(F.atan2(F.sinh(v), F.cos(u))) + self.lon0, F.degrees(F.asin(F.tanh(isometric)))


@dataclass(frozen=True)
class WebMercator:
    """The web map projection: a sphere, for pictures rather than areas."""

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        return mercator_x(lon), mercator_y(lat)


System = LambertConformal | TransverseMercator | WebMercator

# The systems that regions are measured in, by their public register codes.
SYSTEMS: dict[str, System] = {
    "EPSG:3857": WebMercator(),
    "EPSG:32140": LambertConformal(30 + 17 / 60, 28 + 23 / 60, 27 + 50 / 60, -99.0, 600000.0, 4000000.0),
    "EPSG:7131": TransverseMercator(37.75, -122.45, 1.000007, 48000.0, 24000.0),
}


def system_of(system: str | System) -> System:
    if not isinstance(system, str):
        return system
    if system not in SYSTEMS:
        raise ValueError(f"unknown system {system}; known are {', '.join(SYSTEMS)}")
    return SYSTEMS[system]


def project(lon: Column, lat: Column, system: str | System) -> tuple[Column, Column]:
    """Metres east and north of a place in degrees; NULL stays NULL."""
    return system_of(system).project(lon, lat)


def project_geometry(geom: Column, system: str | System) -> Column:
    """A geometry in degrees with every corner projected; sides become straight lines between projected corners."""
    def corner(p: Column) -> Column:
        x, y = project(p["x"], p["y"], system)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(geom, lambda r: F.struct(r["hole"].alias("hole"), F.transform(r["points"], corner).alias("points")))
