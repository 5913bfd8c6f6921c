"""Distances and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MILES = 3958.7613


def haversine_miles(lat: Column, lon: Column, centre: tuple[float, float]) -> Column:
    """Great-circle distance in miles from a fixed point."""
    lat0, lon0 = F.radians(F.lit(centre[0])), F.radians(F.lit(centre[1]))
    dlat, dlon = F.radians(lat) - lat0, F.radians(lon) - lon0
    chord = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat)) * F.cos(lat0) * F.pow(
        F.sin(dlon / 2), 2
    )
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))


def point(lon: Column, lat: Column) -> Column:
    """A point as a struct; NULL when either coordinate is missing."""
    return F.when(
        lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat"))
    )
