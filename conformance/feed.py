"""A trip feed and a zone lookup derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import AllowedValues, CleaningRules, DeliveryLimits, RunConfig
from meterline.operators.staging import OPTIONAL, REQUIRED
from meterline.sources.schemas import RAW_COLUMNS

RULES = CleaningRules(max_fare_usd=100_000, max_trip_miles=48)
CONFIG = RunConfig(
    rules=RULES,
    allowed=AllowedValues(vendors=tuple(range(8)), boroughs=("AFRICA", "Manhattan", "ASIA", "EUROPE", "MIDDLE EAST")),
    limits=DeliveryLimits(min_rows=300, min_retention=0.65),
    enforce=False,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, *, copies: bool = True) -> DataFrame:
    """Raw trips, one per line item; with ``copies`` those of two passengers arrive again a day later."""
    # Whole cents, so that tip and total are exact to the cent, halves rounded up.
    price = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
    trips = (
        table(spark, sf_dir, "lineitem")
        .withColumn(
            "base_day",
            F.expr("IF(l_linenumber = 3 AND l_quantity = 1, l_shipdate - INTERVAL '1' MONTH, l_shipdate)"),
        )
        .withColumn("pickup", F.expr("timestampadd(MINUTE, l_partkey * 37 % 1440, base_day)"))
        .select(
            F.expr("l_suppkey % 8 AS VendorID"),
            F.col("pickup").alias("tpep_pickup_datetime"),
            F.expr("timestampadd(MINUTE, (l_orderkey * 7 + l_linenumber * 13) % 1600 - 60, pickup)").alias(
                "tpep_dropoff_datetime"
            ),
            F.expr("CAST(NULLIF(l_linenumber, 7) AS BIGINT) AS passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.lit(None).cast("bigint").alias("RatecodeID"),
            F.lit(None).cast("string").alias("store_and_fwd_flag"),
            F.col("l_suppkey").alias("PULocationID"),
            F.expr("l_partkey % 100 AS DOLocationID"),
            F.expr("CAST(l_linenumber - 1 AS BIGINT) AS payment_type"),
            F.expr(
                "IF(l_returnflag = 'R' AND l_discount = 0, -l_extendedprice, l_extendedprice) AS fare_amount"
            ),
            F.expr(f"({price} * CAST(rint(l_discount * 100) AS INT) + 50) DIV 100 / 100D AS tip_amount"),
            F.expr(f"({price} * CAST(rint(100 + l_tax * 100) AS INT) + 50) DIV 100 / 100D AS total_amount"),
            F.expr("trunc(to_date(l_shipdate), 'month') AS source_month"),
            F.col("l_shipdate").alias("loaded_at"),
        )
    )
    money = {c: F.lit(None).cast("double") for c, t in RAW_COLUMNS.items() if t == "double" and c not in trips.columns}
    columns = [*RAW_COLUMNS, "source_month", "loaded_at"]
    trip = F.col("trip")
    again = trip.withField("loaded_at", F.expr("timestampadd(DAY, 1, trip.loaded_at)"))
    twice = F.when(trip["passenger_count"] == 2, F.array(trip, again)) if copies else F.when(F.lit(False), F.array(trip))
    # Unpacking a record per trip keeps filters on derived columns from being pushed into their
    # definitions, where each use would compute them again.
    records = trips.withColumns(money).select(F.struct(*columns).alias("trip"))
    return records.select(F.inline(twice.otherwise(F.array(trip))))


def damaged(trips: DataFrame) -> DataFrame:
    """The trips with faults of each kind that the feed itself does not have.

    In even months a required value is missing in 7 rows of 60, each of the seven in turn, far more than a
    delivery may lack. The optional amounts are filled in, in eighths, except for some vendors.
    """
    turn = (F.col("PULocationID") * 7 + F.col("trip_distance").cast("bigint") * 3) % 60
    faulty = F.month("source_month") % 2 == 0
    lost = {c: F.when(faulty & (turn == i), None).otherwise(F.col(c)) for i, c in enumerate(REQUIRED)}
    filled = {
        c: F.when(F.col("VendorID") % (i + 2) != 0, F.col("trip_distance") * F.lit(i + 1) / F.lit(8.0))
        for i, c in enumerate(OPTIONAL)
    }
    return trips.withColumns(lost | filled)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in source layout, one zone per supplier, with blanks to trim."""
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return places.select(
        F.col("s_suppkey").cast("int").alias("LocationID"),
        F.expr("concat('  ', IF(r_name = 'AMERICA', 'Manhattan', r_name), ' ') AS Borough"),
        F.expr("concat(s_name, '  ') AS Zone"),
        F.expr(
            "CASE r_name WHEN 'EUROPE' THEN 'Airports' WHEN 'ASIA' THEN ' EWR' ELSE 'Boro Zone' END AS service_zone"
        ),
    )


def land(trips: DataFrame, folder: str) -> str:
    """Write trips as one delivery per month below a folder, in the feed's own layout."""
    month = F.date_format("source_month", "yyyy-MM")
    named = trips.withColumn("source_file", F.concat(F.lit("yellow_tripdata_"), month, F.lit(".parquet")))
    delivered = named.drop("source_month", "loaded_at")
    delivered.hint("rebalance", F.col("source_file")).write.partitionBy("source_file").parquet(folder)
    return folder


def delivery_path(folder: str, month: str) -> str:
    return f"{folder}/source_file=yellow_tripdata_{month}.parquet"
