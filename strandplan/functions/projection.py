"""Degrees to projected metres (Lambert-93, EPSG:2154) as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the projection: GRS80 and EPSG:2154.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
PARALLELS, ORIGIN_LAT, ORIGIN_LON = (44.0, 49.0), 46.5, 3.0
FALSE_EAST, FALSE_NORTH = 700000.0, 6600000.0


def _constants() -> tuple[float, float, float, float]:
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)

    def m(p: float) -> float:
        return math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)

    def t(p: float) -> float:
        s = e * math.sin(p)
        return math.tan(math.pi / 4 - p / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (*PARALLELS, ORIGIN_LAT))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    f = m(p1) / (n * t(p1) ** n)
    return e, n, SEMI_MAJOR * f, SEMI_MAJOR * f * t(p0) ** n


E, N, SCALE, RHO0 = _constants()


def to_metres(lon: Column, lat: Column) -> tuple[Column, Column]:
    p = F.radians(lat)
    s = F.sin(p) * E
    t = F.tan(math.pi / 4 - p / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))
    rho = F.pow(t, F.lit(N)) * SCALE
    angle = (F.radians(lon) - math.radians(ORIGIN_LON)) * N
    return FALSE_EAST + rho * F.sin(angle), FALSE_NORTH + RHO0 - rho * F.cos(angle)


def looks_like_degrees(x: str, y: str) -> Column:
    """An aggregate: whether all coordinates of a layer without a declared system are in the range of degrees."""
    return F.max(F.greatest(F.abs(x), F.abs(y))) < 180
