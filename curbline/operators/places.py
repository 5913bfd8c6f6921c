"""Coordinates of zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import geo


def resolve_zone_points(
    zones: DataFrame,
    candidates: DataFrame,
    centre: tuple[float, float] = fixed.CITY_CENTRE,
) -> DataFrame:
    """Coordinates from a table of named places ``(place, borough, lat, lon)``.

    A zone named after several places is split at ``/``, ``-`` and ``&``. Each
    part takes its candidate nearest to the centre, and the parts are averaged.
    The nearest candidate per place is found before the join, with one partial
    row per task, so popular place names cost no more than rare ones.
    """
    away = geo.haversine_miles(F.col("lat"), F.col("lon"), centre)
    nearest = (
        candidates.where(away.isNotNull())
        .groupBy("place", "borough")
        .agg(F.min(F.struct(away.alias("away"), "lat", "lon")).alias("best"))
        .select(
            F.col("place").alias("part"), F.col("borough"), "best.lat", "best.lon"
        )
    )
    parts = zones.select(
        "location_id",
        "borough",
        F.explode(F.split("zone", "[/&-]")).alias("part"),
    ).withColumn("part", F.trim("part"))
    points = (
        parts.join(nearest, ["part", "borough"])
        .groupBy("location_id")
        .agg(F.avg("lat").alias("latitude"), F.avg("lon").alias("longitude"))
    )
    return zones.select("location_id", "borough", "zone").join(points, "location_id", "left")


def override_points(zones: DataFrame, overrides: DataFrame) -> DataFrame:
    """Missing coordinates from a table ``(location_id, lat, lon)``; known ones stay."""
    side = overrides.select("location_id", "lat", "lon")
    text = F.concat(F.lit("("), F.col("lat"), F.lit(", "), F.col("lon"), F.lit(")"))
    return (
        zones.join(side, "location_id", "left")
        .withColumns(
            {
                "latitude": F.coalesce("latitude", "lat"),
                "longitude": F.coalesce("longitude", "lon"),
                "geolocation": F.coalesce(F.nullif(F.col("geolocation"), F.lit("")), text),
            }
        )
        .select(*zones.columns)
    )


def missing_points(zones: DataFrame) -> DataFrame:
    """Zones without both coordinates."""
    return zones.where(F.col("latitude").isNull() | F.col("longitude").isNull())
