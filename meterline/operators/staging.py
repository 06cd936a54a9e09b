"""Cleaned trips and cleaned zones."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import CleaningRules
from meterline.functions import expressions as X

REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "total_amount",
    "tip_amount",
)


OPTIONAL = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
)


def cleaning_conditions(rules: CleaningRules = CleaningRules()) -> dict[str, Column]:
    """What a raw row must satisfy, by rule. NULL and NaN count as a failure.

    Money counts with the value it has as DECIMAL(10,2), but no decimal is built to decide on a row.
    A trip with an amount that this type cannot hold, NaN included, counts as one without the amount.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    fare, total, tip, miles = (F.col(c) for c in ("fare_amount", "total_amount", "tip_amount", "trip_distance"))
    # A function over an array stays outside the generated loop, which is at its limit.
    held = F.forall(F.array(tip, *OPTIONAL), lambda a: a.isNull() | (F.abs(a) <= F.lit(X.MAX_MONEY)))
    negative = X.rounds_below_zero(F.least(fare, total, tip))
    return {
        "required": reduce(and_, [F.col(c).isNotNull() for c in REQUIRED], held),
        "not_negative": ~negative & (miles >= 0),
        "fare_cap": ~X.rounds_above(fare, rules.max_fare_usd),
        "total_cap": ~X.rounds_above(total, rules.max_fare_usd),
        "distance_cap": miles <= rules.max_trip_miles,
        "time_order": dropoff >= pickup,
        "under_24h": dropoff < pickup + F.expr("INTERVAL '24' HOUR"),
        "own_month": X.month_of(pickup) == F.col("source_month"),
    }


def type_trips(raw: DataFrame) -> DataFrame:
    """Raw rows renamed and typed, with a key; optional amounts that are missing become 0."""

    def or_zero(column: str) -> Column:
        return X.money(F.coalesce(F.col(column), F.lit(0.0)))

    return raw.select(
        X.trip_key().alias("trip_id"),
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance_miles"),
        F.col("RatecodeID").cast("int").alias("rate_code_id"),
        F.col("store_and_fwd_flag"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        F.col("payment_type").cast("int").alias("payment_type_id"),
        X.money(F.col("fare_amount")).alias("fare_amount"),
        or_zero("extra").alias("extra_amount"),
        or_zero("mta_tax").alias("mta_tax_amount"),
        X.money(F.col("tip_amount")).alias("tip_amount"),
        or_zero("tolls_amount").alias("tolls_amount"),
        or_zero("improvement_surcharge").alias("improvement_surcharge_amount"),
        or_zero("congestion_surcharge").alias("congestion_surcharge_amount"),
        or_zero("Airport_fee").alias("airport_fee_amount"),
        or_zero("cbd_congestion_fee").alias("cbd_congestion_fee_amount"),
        X.money(F.col("total_amount")).alias("total_amount"),
        F.col("source_month"),
        F.col("loaded_at"),
    )


def stage_trips(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Valid trips, typed. Rows that break a rule are dropped, never repaired."""
    return type_trips(raw.where(reduce(and_, cleaning_conditions(rules).values())))


def drop_counts(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Rows failing each rule, rules counted separately, in one pass."""
    conditions = cleaning_conditions(rules)
    failed = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in conditions.items()]
    kept = F.count_if(F.coalesce(reduce(and_, conditions.values()), F.lit(False)))
    return raw.agg(F.count(F.lit(1)).alias("rows"), *failed, kept.alias("kept"))


def stage_zones(zones: DataFrame) -> DataFrame:
    """Typed zones without blanks around their names."""
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.trim("Borough").alias("borough"),
        F.trim("Zone").alias("zone"),
        F.trim("service_zone").alias("service_zone"),
    )
