"""Zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.expressions import AIRPORT_SERVICE_ZONES


def dim_zones(zones: DataFrame) -> DataFrame:
    """Staged zones with flags for airports and Manhattan; NULL names give NULL flags."""
    return zones.select(
        "location_id",
        "borough",
        "zone",
        "service_zone",
        F.col("service_zone").isin(*AIRPORT_SERVICE_ZONES).alias("is_airport"),
        (F.col("borough") == "Manhattan").alias("is_manhattan"),
    )
