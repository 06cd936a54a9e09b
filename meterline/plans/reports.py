"""Report queries over the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first(df: DataFrame, label: str, *order: Column) -> DataFrame:
    """First row of an order, computed per task and merged, never by a full sort."""
    return df.orderBy(*order).limit(1).select(F.lit(label).alias("extreme"), "*")


def daily_revenue_series(daily: DataFrame) -> DataFrame:
    """Revenue per day in millions, in date order."""
    return daily.select(
        "pickup_date", (F.col("total_revenue").cast("double") / F.lit(1e6)).alias("revenue_musd")
    ).orderBy("pickup_date")


def daily_revenue_extremes(daily: DataFrame) -> DataFrame:
    """Peak and low day (the earlier of equals) with the number of days and the revenue of all."""
    series = daily.select("pickup_date", "total_revenue")
    days = [
        _first(series, "peak", F.desc("total_revenue"), F.asc("pickup_date")),
        _first(series, "low", F.asc("total_revenue"), F.asc("pickup_date")),
    ]
    overall = series.agg(
        F.lit("all").alias("extreme"),
        F.count(F.lit(1)).alias("days"),
        F.sum(F.col("total_revenue").cast("decimal(28,2)")).cast("decimal(38,2)").alias("total_revenue"),
    )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), days, overall).select(
        "extreme", "pickup_date", "days", (F.col("total_revenue").cast("double") / F.lit(1e6)).alias("revenue_musd")
    )


def busiest_zones(zones: DataFrame, n: int = 10) -> DataFrame:
    """Zones with most trips, in thousands; equals in order of their id."""
    return (
        zones.orderBy(F.desc("trip_count"), F.asc("location_id"))
        .limit(n)
        .select(
            F.concat("zone", F.lit(" ("), "borough", F.lit(")")).alias("label"),
            "trip_count",
            (F.col("trip_count") / F.lit(1e3)).alias("trips_thousand"),
        )
    )


def tip_by_hour(hourly: DataFrame) -> DataFrame:
    """Weighted tip percentage per hour, the highest and lowest hour marked; hours may be missing.

    A single known hour is the highest.
    """
    series = hourly.select("pickup_hour", "weighted_tip_pct")
    known = series.where(F.col("weighted_tip_pct").isNotNull())
    marks = [
        _first(known, "highest", F.desc("weighted_tip_pct"), F.asc("pickup_hour")),
        _first(known, "lowest", F.asc("weighted_tip_pct"), F.asc("pickup_hour")),
    ]
    marked = reduce(DataFrame.unionByName, marks).groupBy("pickup_hour").agg(F.min("extreme").alias("extreme"))
    return series.join(marked, "pickup_hour", "left").orderBy("pickup_hour")
