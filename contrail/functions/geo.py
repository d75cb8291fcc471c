"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points in degrees; null when any coordinate is null.

    Rounding can push the half-chord a hair over 1 near antipodes, so it is
    clamped before the arc sine.
    """
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = (half_lat * half_lat
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(
        known, F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(chord))))
