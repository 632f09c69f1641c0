"""Great-circle geometry as Column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: mean Earth radius in km used for all distances
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """MTH-1 / UDF-1: great-circle distance in km (haversine, atan2 form).

    The haversine term is clamped to [0, 1] so that rounding near antipodes
    cannot produce NaN.
    """
    phi1 = F.radians(_c(lat1).cast("double"))
    phi2 = F.radians(_c(lat2).cast("double"))
    dphi = F.radians((_c(lat2) - _c(lat1)).cast("double"))
    dlam = F.radians((_c(lon2) - _c(lon1)).cast("double"))
    s_phi = F.sin(dphi / 2)
    s_lam = F.sin(dlam / 2)
    a = s_phi * s_phi + F.cos(phi1) * F.cos(phi2) * s_lam * s_lam
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def unit_xyz_km(lat, lon) -> tuple[Column, Column, Column]:
    """Point on the sphere of radius EARTH_RADIUS_KM as 3-D coordinates (km)."""
    phi = F.radians(_c(lat).cast("double"))
    lam = F.radians(_c(lon).cast("double"))
    r = F.lit(EARTH_RADIUS_KM)
    return r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)


def chord_km(great_circle_km) -> Column:
    """Straight-line (chord) length for a great-circle distance; monotonic."""
    r = F.lit(EARTH_RADIUS_KM)
    return 2 * r * F.sin(_c(great_circle_km) / (2 * r))
