"""Daily, hourly and zone marts.

All three are ratios of sums, so they are built from cells: one row of sums and counts per
month, day, hour and pickup zone. Cells of a month change only with that month's fact rows. A
monthly run therefore reads that month of the fact once and never the fact's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.functions.expressions import safe_divide

CELL_KEYS = ["source_month", "pickup_date", "pickup_hour", "pickup_location_id"]


def _measures() -> dict[str, Column]:
    card = F.col("tip_pct").isNotNull()
    out = {
        "trip_count": F.count(F.lit(1)),
        "total_revenue": F.sum("total_amount"),
        "fare_revenue": F.sum("fare_amount"),
        "fares": F.count("fare_amount"),
        "tip_revenue": F.sum("tip_amount"),
        "card_tips": F.sum(F.when(card, F.col("tip_amount"))),
        "card_fares": F.sum(F.when(card, F.col("fare_amount"))),
    }
    for name in ("trip_distance_miles", "duration_minutes", "tip_pct", "avg_speed_mph"):
        out[f"{name}_sum"] = F.sum(name)
        out[f"{name}_count"] = F.count(name)
    return out


def trip_cells(fact: DataFrame, keys: list[str] = CELL_KEYS) -> DataFrame:
    """Sums and counts of the fact per combination of ``keys``."""
    return fact.groupBy(*keys).agg(*(measure.alias(name) for name, measure in _measures().items()))


def _merged(cells: DataFrame, *keys: str, **extra: Column) -> DataFrame:
    sums = (F.sum(name).alias(name) for name in _measures())
    return cells.groupBy(*keys).agg(*sums, *(column.alias(name) for name, column in extra.items()))


def _total(name: str) -> Column:
    return F.col(name).cast("decimal(38,2)").alias(name)


def _avg_fare() -> Column:
    return safe_divide(F.col("fare_revenue"), F.col("fares")).alias("avg_fare")


def _average(name: str, alias: str) -> Column:
    return safe_divide(F.col(f"{name}_sum"), F.col(f"{name}_count")).alias(alias)


def _weighted_tip_pct() -> Column:
    """Card tips in percent of card fares; unlike the mean of percentages not inflated by tiny fares."""
    return (F.lit(100.0) * safe_divide(F.col("card_tips"), F.col("card_fares"))).alias("weighted_tip_pct")


def weighted_tip_overall(cells: DataFrame) -> DataFrame:
    """Plain and weighted tip percentage over everything."""
    return _merged(cells).select(_average("tip_pct", "avg_tip_pct"), _weighted_tip_pct())


def mart_daily_revenue(cells: DataFrame) -> DataFrame:
    return _merged(cells, "pickup_date").select(
        "pickup_date",
        "trip_count",
        _total("total_revenue"),
        _total("fare_revenue"),
        _total("tip_revenue"),
        _avg_fare(),
        _average("trip_distance_miles", "avg_trip_distance_miles"),
        _average("tip_pct", "avg_tip_pct"),
        _weighted_tip_pct(),
    )


def mart_hourly_demand(cells: DataFrame) -> DataFrame:
    return _merged(cells, "pickup_hour", days_observed=F.count_distinct("pickup_date")).select(
        "pickup_hour",
        "trip_count",
        "days_observed",
        safe_divide(F.col("trip_count"), F.col("days_observed")).alias("avg_trips_per_day"),
        _avg_fare(),
        _average("tip_pct", "avg_tip_pct"),
        _weighted_tip_pct(),
        _average("avg_speed_mph", "avg_speed_mph"),
    )


def _ranked(zones: DataFrame) -> DataFrame:
    """Rank and total of any number of zones: the distinct trip counts are ranked, and each zone's is looked up.

    n distinct counts need at least n * (n + 1) / 2 trips, so a million million trips have
    under 1.5 million of them: few enough for one window.
    """
    higher = W.orderBy(F.desc("trip_count")).rowsBetween(W.unboundedPreceding, -1)
    ranks = (
        zones.groupBy("trip_count")
        .agg(F.count(F.lit(1)).alias("zones"))
        .select(
            "trip_count",
            (F.coalesce(F.sum("zones").over(higher), F.lit(0)) + 1).alias("trip_count_rank"),
            F.sum(F.col("zones") * F.col("trip_count")).over(W.partitionBy()).alias("all_trips"),
        )
    )
    return zones.join(ranks, "trip_count")


def mart_zone_performance(cells: DataFrame, dim: DataFrame) -> DataFrame:
    """Pickup zone leaderboard. Zones missing from the dimension vanish, from the shares too."""
    names = dim.select("location_id", "borough", "zone")
    by_zone = _merged(cells, "pickup_location_id").withColumnRenamed("pickup_location_id", "location_id")
    return _ranked(by_zone.join(names, "location_id")).select(
        "location_id",
        "borough",
        "zone",
        "trip_count",
        _total("total_revenue"),
        _avg_fare(),
        _average("trip_distance_miles", "avg_trip_distance_miles"),
        _average("duration_minutes", "avg_duration_minutes"),
        _average("tip_pct", "avg_tip_pct"),
        _weighted_tip_pct(),
        "trip_count_rank",
        F.round(safe_divide(F.lit(100.0) * F.col("trip_count"), F.col("all_trips")), 3).alias("pct_of_all_trips"),
    )
