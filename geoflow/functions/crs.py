"""Closed-form projections as SQL arithmetic (Snyder, USGS PP 1395; Krueger series for UTM).

Every change of coordinate system goes through longitude/latitude.  A projection is a short list of
steps, each a function from the text of one ``struct<x,y>`` to another; splitting it keeps the expressions
small where a value is used several times.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import map_vertices, xy
from .layer import GEOM, is_point_layer, replace_geom, srid_of
from .sql import num

Step = Callable[[str], str]

# EPSG definitions.
GEOGRAPHIC = (4326, 4171)
WEB_MERCATOR = 3857
SPHERE_RADIUS = 6378137.0
SEMI_MAJOR = 6378137.0
GRS80_FLATTENING = 1 / 298.257222101
WGS84_FLATTENING = 1 / 298.257223563
# code: (first parallel, second parallel, latitude of origin, longitude of origin, false easting, false northing)
LAMBERT = {
    2154: (44.0, 49.0, 46.5, 3.0, 700000.0, 6600000.0),
    3945: (44.25, 45.75, 45.0, 3.0, 1700000.0, 4200000.0),
    3946: (45.25, 46.75, 46.0, 3.0, 1700000.0, 5200000.0),
}
# code: central meridian
UTM = {32631: 3.0, 32632: 9.0}
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0

SUPPORTED = (*GEOGRAPHIC, WEB_MERCATOR, *LAMBERT, *UTM)


def check_srid(srid: int) -> int:
    if srid not in SUPPORTED:
        raise ValueError(f"unsupported coordinate system EPSG:{srid}; known: {sorted(SUPPORTED)}")
    return srid


def is_geographic(srid: int) -> bool:
    return check_srid(srid) in GEOGRAPHIC


def _eccentricity(flattening: float) -> float:
    return math.sqrt(flattening * (2 - flattening))


def _isometric_latitude(phi: str, e: float) -> str:
    return f"(asinh(tan({phi})) - {num(e)} * atanh({num(e)} * sin({phi})))"


def _latitude_degrees(psi: str, e: float) -> str:
    """Geodetic latitude of an isometric latitude; five fixed-point steps reach double precision."""
    s = f"tanh({psi})"
    for _ in range(5):
        s = f"tanh({psi} + {num(e)} * atanh({num(e)} * {s}))"
    return f"degrees(asin({s}))"


class _LambertCone:
    def __init__(self, lat1: float, lat2: float, lat0: float, lon0: float, fe: float, fn: float) -> None:
        e = self.e = _eccentricity(GRS80_FLATTENING)

        def psi(lat: float) -> float:
            phi = math.radians(lat)
            return math.asinh(math.tan(phi)) - e * math.atanh(e * math.sin(phi))

        def m(lat: float) -> float:
            phi = math.radians(lat)
            return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

        self.n = (math.log(m(lat1)) - math.log(m(lat2))) / (psi(lat2) - psi(lat1))
        self.scale = SEMI_MAJOR * m(lat1) * math.exp(self.n * psi(lat1)) / self.n
        self.rho0 = self.scale * math.exp(-self.n * psi(lat0))
        self.lon0, self.fe, self.fn = lon0, fe, fn

    def forward(self) -> list[Step]:
        def polar(p: str) -> str:
            psi = _isometric_latitude(f"radians({p}.y)", self.e)
            return xy(
                f"{num(self.n)} * radians({p}.x - {num(self.lon0)})",
                f"{num(self.scale)} * exp(-{num(self.n)} * {psi})",
            )

        def plane(p: str) -> str:
            return xy(
                f"{num(self.fe)} + {p}.y * sin({p}.x)", f"{num(self.fn + self.rho0)} - {p}.y * cos({p}.x)"
            )

        return [polar, plane]

    def inverse(self) -> list[Step]:
        def polar(p: str) -> str:
            return xy(f"{p}.x - {num(self.fe)}", f"{num(self.rho0 + self.fn)} - {p}.y")

        def isometric(p: str) -> str:
            return xy(
                f"{num(self.lon0)} + degrees(atan2({p}.x, {p}.y)) / {num(self.n)}",
                f"-ln(hypot({p}.x, {p}.y) / {num(self.scale)}) / {num(self.n)}",
            )

        def geodetic(p: str) -> str:
            return xy(f"{p}.x", _latitude_degrees(f"{p}.y", self.e))

        return [polar, isometric, geodetic]


class _TransverseMercator:
    def __init__(self, lon0: float) -> None:
        f = WGS84_FLATTENING
        n = f / (2 - f)
        self.e = _eccentricity(f)
        self.lon0 = lon0
        self.radius = UTM_SCALE * SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        self.alpha = (
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        )
        self.beta = (
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        )

    @staticmethod
    def _series(p: str, coefficients: tuple[float, ...], sign: float) -> tuple[str, str]:
        """Corrected (xi, eta) for ``p.x`` = xi and ``p.y`` = eta."""
        xi, eta = f"{p}.x", f"{p}.y"
        for j, c in enumerate(coefficients, start=1):
            xi += f" + {num(sign * c)} * sin({2 * j} * {p}.x) * cosh({2 * j} * {p}.y)"
            eta += f" + {num(sign * c)} * cos({2 * j} * {p}.x) * sinh({2 * j} * {p}.y)"
        return f"({xi})", f"({eta})"

    def forward(self) -> list[Step]:
        def conformal(p: str) -> str:
            psi = _isometric_latitude(f"radians({p}.y)", self.e)
            return xy(f"radians({p}.x - {num(self.lon0)})", f"sinh({psi})")

        def sphere(p: str) -> str:
            return xy(f"atan2({p}.y, cos({p}.x))", f"asinh(sin({p}.x) / hypot({p}.y, cos({p}.x)))")

        def plane(p: str) -> str:
            xi, eta = self._series(p, self.alpha, 1.0)
            return xy(
                f"{num(UTM_FALSE_EASTING)} + {num(self.radius)} * {eta}", f"{num(self.radius)} * {xi}"
            )

        return [conformal, sphere, plane]

    def inverse(self) -> list[Step]:
        def scaled(p: str) -> str:
            return xy(
                f"{p}.y / {num(self.radius)}", f"({p}.x - {num(UTM_FALSE_EASTING)}) / {num(self.radius)}"
            )

        def sphere(p: str) -> str:
            return xy(*self._series(p, self.beta, -1.0))

        def isometric(p: str) -> str:
            return xy(
                f"{num(self.lon0)} + degrees(atan2(sinh({p}.y), cos({p}.x)))", f"atanh(sin({p}.x) / cosh({p}.y))"
            )

        def geodetic(p: str) -> str:
            return xy(f"{p}.x", _latitude_degrees(f"{p}.y", self.e))

        return [scaled, sphere, isometric, geodetic]


def _web_forward(p: str) -> str:
    r = num(SPHERE_RADIUS)
    return xy(f"{r} * radians({p}.x)", f"{r} * asinh(tan(radians({p}.y)))")


def _web_inverse(p: str) -> str:
    r = num(SPHERE_RADIUS)
    return xy(f"degrees({p}.x / {r})", f"degrees(asin(tanh({p}.y / {r})))")


def projection_steps(source: int, target: int) -> list[Step]:
    """Steps that take a vertex from one coordinate system to another."""
    check_srid(source), check_srid(target)
    if source == target or (source in GEOGRAPHIC and target in GEOGRAPHIC):
        return []
    steps: list[Step] = []
    if source == WEB_MERCATOR:
        steps.append(_web_inverse)
    elif source in LAMBERT:
        steps += _LambertCone(*LAMBERT[source]).inverse()
    elif source in UTM:
        steps += _TransverseMercator(UTM[source]).inverse()
    if target == WEB_MERCATOR:
        steps.append(_web_forward)
    elif target in LAMBERT:
        steps += _LambertCone(*LAMBERT[target]).forward()
    elif target in UTM:
        steps += _TransverseMercator(UTM[target]).forward()
    return steps


def reproject_geom(geom: str, source: int, target: int, points: bool = False) -> str:
    steps = projection_steps(source, target)
    return map_vertices(geom, steps, points) if steps else geom


def reproject(df: DataFrame, target: int = 4326, source: int | None = None, geom: str = GEOM) -> DataFrame:
    """Move a layer to another coordinate system.

    The layer's own system wins over ``source``; with neither, longitude/latitude is assumed.
    """
    origin = srid_of(df, geom) or source or 4326
    points = is_point_layer(df, geom)
    moved = F.expr(reproject_geom(geom, origin, target, points))
    return replace_geom(df, moved, geom, srid=target, kind="Point" if points else None)
