"""Reprojection between longitude/latitude and the metric plane EPSG:3163, as native columns.

Lambert conformal conic with two parallels on GRS80, by the public formulas of the map projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 axis and flattening, and the projection's parameters in degrees and metres.
AXIS = 6378137.0
FLATTENING = 1 / 298.257222101
LAT_1, LAT_2 = -(20 + 40 / 60), -(22 + 20 / 60)
LAT_0, LON_0 = -21.5, 166.0
FALSE_EAST, FALSE_NORTH = 400_000.0, 300_000.0

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


def _t(lat: float) -> float:
    s = math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)


_P1, _P2, _P0 = (math.radians(v) for v in (LAT_1, LAT_2, LAT_0))
_N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
_SCALE = _m(_P1) / (_N * _t(_P1) ** _N)
_R0 = AXIS * _SCALE * _t(_P0) ** _N


def to_plane(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres."""
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - s) / (F.lit(1.0) + s), F.lit(_E / 2))
    radius = F.pow(t, F.lit(_N)) * (AXIS * _SCALE)
    theta = F.radians(lon - LON_0) * _N
    return radius * F.sin(theta) + FALSE_EAST, F.lit(_R0 + FALSE_NORTH) - radius * F.cos(theta)


def to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres to degrees; the latitude by six fixed steps of the usual iteration."""
    sign = math.copysign(1.0, _N)
    dx, dy = (x - FALSE_EAST) * sign, (F.lit(_R0 + FALSE_NORTH) - y) * sign
    radius = F.sqrt(dx * dx + dy * dy) * sign
    t = F.pow(radius / (AXIS * _SCALE), F.lit(1 / _N))
    half_pi = math.pi / 2

    def refine(phi: Column, _step: Column) -> Column:
        s = F.sin(phi) * _E
        return F.lit(half_pi) - F.atan(t * F.pow((F.lit(1.0) - s) / (F.lit(1.0) + s), F.lit(_E / 2))) * 2

    phi = F.aggregate(F.sequence(F.lit(1), F.lit(6)), F.lit(half_pi) - F.atan(t) * 2, refine)
    return F.degrees(F.atan2(dx, dy) / _N) + LON_0, F.degrees(phi)
