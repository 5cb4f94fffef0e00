"""Great-circle distance as a native expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def haversine_km(
    lat1: Column | float, lon1: Column | float, lat2: Column | float, lon2: Column | float
) -> Column:
    """Distance in km between two points in degrees; null when a coordinate is null.

    Rounding can push the squared half chord just outside [0, 1]: a negative one counts as its tiny
    magnitude, and one above 1 (antipodes) as half the globe.
    """
    phi1, lam1, phi2, lam2 = (F.radians(_column(v)) for v in (lat1, lon1, lat2, lon2))
    north = F.sin((phi2 - phi1) / 2)
    east = F.sin((lam2 - lam1) / 2)
    half_chord = F.sqrt(F.abs(north * north + F.cos(phi1) * F.cos(phi2) * (east * east)))
    half_angle = F.nanvl(F.asin(half_chord), F.lit(math.pi / 2))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * half_angle)


def unit_vector(lat: Column | float, lon: Column | float) -> tuple[Column, Column, Column]:
    """The point's place on the unit sphere."""
    phi, lam = F.radians(_column(lat)), F.radians(_column(lon))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def squared_chord(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Squared straight-line distance of two unit vectors; it grows with the great-circle distance."""
    x, y, z = (p - q for p, q in zip(a, b))
    return x * x + y * y + z * z
