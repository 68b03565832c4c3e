"""Great-circle distance as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trailperks import labels as L


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance between two points in degrees, on a sphere."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    return F.lit(2 * L.EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
