"""Planar geometry as Column arithmetic.

Stop coordinates (WGS84 degrees) are projected with the closed form of the
Lambert conformal conic projection, two standard parallels, using the public
definition of the New York Long Island State Plane zone in US survey feet.
The datum shift WGS84 -> NAD83 is taken as zero.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Projection definition (GRS80 ellipsoid; parallels 41 02' and
# 40 40'; origin 40 10' N, 74 00' W; false easting 300000 m; US survey foot).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
LAT_1 = 41.0 + 2.0 / 60.0
LAT_2 = 40.0 + 40.0 / 60.0
LAT_0 = 40.0 + 10.0 / 60.0
LON_0 = -74.0
FALSE_EASTING_M = 300000.0
FALSE_NORTHING_M = 0.0
US_FOOT_M = 1200.0 / 3937.0


def _lcc_constants():
    f = 1.0 / GRS80_INV_F
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (LAT_1, LAT_2, LAT_0))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


E, N, BIG_F, RHO0 = _lcc_constants()


def project_xy(lon, lat) -> tuple[Column, Column]:
    """(lon, lat) degrees -> (x, y) US survey feet. Null in, null out."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    phi = F.radians(lat)
    esin = F.lit(E) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - esin) / (1 + esin), F.lit(E / 2))
    rho = F.lit(GRS80_A * BIG_F) * F.pow(t, F.lit(N))
    theta = F.lit(N) * F.radians(lon - F.lit(LON_0))
    x = (F.lit(FALSE_EASTING_M) + rho * F.sin(theta)) / F.lit(US_FOOT_M)
    y = (F.lit(FALSE_NORTHING_M) + F.lit(RHO0) - rho * F.cos(theta)) / F.lit(US_FOOT_M)
    return x, y


def segment_length(x1, y1, x2, y2) -> Column:
    return F.sqrt(F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2))
