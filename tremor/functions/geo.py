"""Geometry on the sphere and ellipsoid, as column expressions.

Everything here except ``geodesic_km`` is built from Spark's own math
functions and stays inside whole-stage codegen.  ``geodesic_km`` is an
Arrow-batched pandas UDF (vectorised numpy, no per-row Python) that is only
ever applied to the handful of candidates that survive a haversine bound.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Mean Earth radius (IUGG) and the WGS-84 ellipsoid.
EARTH_RADIUS_KM = 6371.0088
WGS84_A_M = 6378137.0
WGS84_F = 1 / 298.257223563
# Web-Mercator tile latitude limit in degrees.
MERCATOR_LAT_LIMIT = 85.0511287798066


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_a(lat1, lon1, lat2, lon2) -> Column:
    """The haversine term ``sin^2(theta/2)`` of the central angle theta."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dp = F.sin(F.radians(_col(lat2) - _col(lat1)) / 2)
    dl = F.sin(F.radians(_col(lon2) - _col(lon1)) / 2)
    return dp * dp + F.cos(p1) * F.cos(p2) * dl * dl


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on the mean sphere, in km."""
    a = haversine_a(lat1, lon1, lat2, lon2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def unit_xyz(lat, lon) -> tuple[Column, Column, Column]:
    """Unit-sphere coordinates: no seam at +-180 degrees and none at the poles."""
    p, l = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)


def chord_for_km(km: Column, margin: float = 1.0) -> Column:
    """Chord length (unit sphere) of an arc of ``margin * km``."""
    theta = F.least(_col(km) * F.lit(margin / EARTH_RADIUS_KM), F.lit(math.pi))
    return F.lit(2.0) * F.sin(theta / 2)


def tile_xy(lat, lon, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator (slippy map) tile of a point at ``zoom``; positions nearer to a
    pole than the map reaches belong to its first or last row."""
    n = float(2**zoom)
    limit = F.lit(MERCATOR_LAT_LIMIT)
    p = F.radians(F.greatest(F.least(_col(lat), limit), -limit))
    x = F.floor((_col(lon) + F.lit(180.0)) / F.lit(360.0) * F.lit(n))
    y = F.floor((F.lit(1.0) - F.ln(F.tan(p) + F.lit(1.0) / F.cos(p)) / F.lit(math.pi)) / F.lit(2.0) * F.lit(n))
    top = F.lit(int(n) - 1)
    return F.least(x.cast("long"), top), F.greatest(F.least(y.cast("long"), top), F.lit(0))


def place_label(city, town, village, country) -> Column:
    """``"City, Country"`` from the first present of city/town/village, else the country."""
    place = F.coalesce(_col(city), _col(town), _col(village))
    nation = F.coalesce(_col(country), F.lit("Unknown"))
    return F.when(place.isNotNull(), F.concat(place, F.lit(", "), nation)).otherwise(nation)


def vincenty_np(lat1, lon1, lat2, lon2, max_iter: int = 200, tol: float = 1e-12) -> np.ndarray:
    """Vincenty (1975) inverse solution on WGS-84, vectorised; NaN where it does not converge."""
    a, f = WGS84_A_M, WGS84_F
    b = (1 - f) * a
    lat1, lon1, lat2, lon2 = (np.radians(np.asarray(v, dtype="float64")) for v in (lat1, lon1, lat2, lon2))
    big_l = lon2 - lon1
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = big_l.copy()
    done = np.zeros(lam.shape, dtype=bool)
    sin_s = np.zeros_like(lam)
    cos_s = np.zeros_like(lam)
    sig = np.zeros_like(lam)
    cos2a = np.zeros_like(lam)
    cos2sm = np.zeros_like(lam)
    for _ in range(max_iter):
        # Each pair keeps the terms of the iteration in which it converged, so
        # its result never depends on the other pairs in the batch.
        live = ~done
        sl, cl = np.sin(lam), np.cos(lam)
        s_s = np.sqrt((cu2 * sl) ** 2 + (cu1 * su2 - su1 * cu2 * cl) ** 2)
        c_s = su1 * su2 + cu1 * cu2 * cl
        sg = np.arctan2(s_s, c_s)
        with np.errstate(invalid="ignore", divide="ignore"):
            sin_a = np.where(s_s == 0, 0.0, cu1 * cu2 * sl / s_s)
            c2a = 1 - sin_a**2
            c2sm = np.where(c2a == 0, 0.0, c_s - 2 * su1 * su2 / c2a)
        c = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        new = big_l + (1 - c) * f * sin_a * (sg + c * s_s * (c2sm + c * c_s * (-1 + 2 * c2sm**2)))
        sin_s = np.where(live, s_s, sin_s)
        cos_s = np.where(live, c_s, cos_s)
        sig = np.where(live, sg, sig)
        cos2a = np.where(live, c2a, cos2a)
        cos2sm = np.where(live, c2sm, cos2sm)
        converged = live & (np.abs(new - lam) < tol)
        lam = np.where(live, new, lam)
        done |= converged
        if done.all():
            break
    u_sq = cos2a * (a * a - b * b) / (b * b)
    big_a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
    big_b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
    d_sig = big_b * sin_s * (
        cos2sm + big_b / 4 * (cos_s * (-1 + 2 * cos2sm**2) - big_b / 6 * cos2sm * (-3 + 4 * sin_s**2) * (-3 + 4 * cos2sm**2))
    )
    metres = b * big_a * (sig - d_sig)
    metres = np.where(sin_s == 0, 0.0, metres)
    return np.where(done, metres / 1000.0, np.nan)


def _waypoint(lat, lon, azimuth) -> tuple[np.ndarray, np.ndarray]:
    """The position a quarter of the sphere away in the direction ``azimuth`` (radians), in degrees."""
    p, a = np.radians(lat), azimuth
    return np.degrees(np.arcsin(np.cos(p) * np.cos(a))), np.degrees(np.radians(lon) + np.arctan2(np.sin(a), -np.sin(p) * np.cos(a)))


def antipodal_km(lat1: float, lon1: float, lat2: float, lon2: float, grid: int = 144, rounds: int = 60) -> float:
    """Ellipsoidal distance of two nearly antipodal points.

    Any path between them crosses the circle of points a quarter of the sphere
    from the first, so the distance is the least sum, over that circle, of the
    two distances to a waypoint; there Vincenty always converges.  A grid of
    directions, then a golden-section search around its local minima.
    """
    def through(azimuth):
        lat, lon = _waypoint(lat1, lon1, azimuth)
        n = np.ones_like(azimuth)
        return vincenty_np(lat1 * n, lon1 * n, lat, lon) + vincenty_np(lat, lon, lat2 * n, lon2 * n)

    step = 2 * math.pi / grid
    at = np.arange(grid) * step
    total = through(at)
    low = (total <= np.roll(total, 1)) & (total <= np.roll(total, -1))
    a, b, g = at[low] - step, at[low] + step, (math.sqrt(5) - 1) / 2
    for _ in range(rounds):
        c, d = b - g * (b - a), a + g * (b - a)
        left = through(c) <= through(d)
        a, b = np.where(left, a, c), np.where(left, d, b)
    return float(through((a + b) / 2).min())


def geodesic_np(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Ellipsoidal distance in km: Vincenty, and ``antipodal_km`` where it does not converge."""
    args = [np.asarray(v, dtype="float64") for v in (lat1, lon1, lat2, lon2)]
    km = vincenty_np(*args)
    for i in np.flatnonzero(np.isnan(km) & np.isfinite(sum(args))):
        km[i] = antipodal_km(*(float(v[i]) for v in args))
    return km


@F.pandas_udf(DoubleType())
def geodesic_km(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Ellipsoidal distance in km."""
    return pd.Series(geodesic_np(lat1.to_numpy(), lon1.to_numpy(), lat2.to_numpy(), lon2.to_numpy()))


# Ship this module's Python code inside the pickled UDF (by value), so
# executors need numpy and pandas but not this package on their path.
def _pickle_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
