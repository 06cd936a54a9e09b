"""Derived measures and zone names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import expressions as X


def derive_measures(trips: DataFrame) -> DataFrame:
    """Duration, speed and tip percentage; no join, so models that need no names stay join-free."""
    timed = trips.withColumn("duration_minutes", X.duration_minutes(F.col("pickup_ts"), F.col("dropoff_ts")))
    return timed.withColumns(
        {
            "avg_speed_mph": X.avg_speed_mph(F.col("trip_distance_miles"), F.col("duration_minutes")),
            "tip_pct": X.tip_pct(F.col("payment_type_id"), F.col("tip_amount"), F.col("fare_amount")),
        }
    )


def add_zone_names(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Names of the pickup and dropoff zones; a trip with an unknown zone stays, with NULL names."""
    names = zones.select("location_id", "borough", "zone")
    for role in ("pickup", "dropoff"):
        lookup = names.select(
            F.col("location_id").alias(f"{role}_location_id"),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone").alias(f"{role}_zone"),
        )
        trips = trips.join(lookup, f"{role}_location_id", "left")
    return trips


def enrich_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged trips with zone names and derived measures, in that column order."""
    named = ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"]
    return derive_measures(add_zone_names(trips, zones).select(*trips.columns, *named))
