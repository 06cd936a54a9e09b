"""Zone lookup source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.sources.schemas import ZONE_SCHEMA


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The lookup CSV with pinned types; "N/A" is ordinary text and no value is turned into NULL by name."""
    return spark.read.schema(ZONE_SCHEMA).option("header", True).csv(path)
