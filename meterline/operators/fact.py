"""The trip fact: window, deduplication, projection, incremental build."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.config import CleaningRules
from meterline.functions import expressions as X
from meterline.operators.enrich import derive_measures
from meterline.operators.staging import stage_trips
from meterline.sources import tables

KEY = "trip_id"

# Staged columns the fact is made of. Its other columns are derived from these after the
# deduplication, which keeps the shuffled rows narrow.
_BASE = [
    "trip_id",
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance_miles",
    "payment_type_id",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "source_month",
]

FACT_COLUMNS = [
    "trip_id",
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance_miles",
    "duration_minutes",
    "avg_speed_mph",
    "payment_type_id",
    "payment_type_name",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "tip_pct",
    "source_month",
]


def latest_per_key(df: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """One row per key: the one with the largest ``newest``, further ties settled by all other columns.

    Spark limits every key to one row in each task before it shuffles, so a key with a great
    many copies costs no more than any other.
    """
    rest = [c for c in df.columns if c not in (*keys, newest)]
    order = W.partitionBy(*keys).orderBy(F.desc(newest), *(F.desc_nulls_last(c) for c in rest))
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def project_fact(trips: DataFrame) -> DataFrame:
    """Calendar parts, payment label and derived measures over deduplicated trips."""
    ts = F.col("pickup_ts")
    return (
        derive_measures(trips)
        .withColumns(
            {
                "pickup_date": F.to_date(ts),
                "pickup_hour": F.hour(ts),
                "pickup_day_of_week": X.iso_weekday(ts),
                "is_weekend": X.is_weekend(ts),
                "payment_type_name": X.payment_type_name(F.col("payment_type_id")),
            }
        )
        .select(*FACT_COLUMNS)
    )


def fact_rows(staged: DataFrame, *, gathered: bool = False) -> DataFrame:
    """Fact rows of staged trips. Filter to the wanted window first: no filter moves below the ranking.

    ``gathered`` brings the rows of a month together for writing, before the derived columns make them wider.
    """
    # A staged key is the text of 16 bytes; those are shuffled.
    trips = staged.select(*_BASE, "loaded_at").withColumn(KEY, F.unhex(KEY))
    trips = latest_per_key(trips, [KEY], "loaded_at").drop("loaded_at")
    if gathered:
        trips = trips.hint("rebalance", F.col(tables.MONTH))
    return project_fact(trips.withColumn(KEY, F.lower(F.hex(KEY))))


def in_window(raw: DataFrame, start: date, end: date | None = None) -> DataFrame:
    """Raw rows picked up from ``start`` on, up to but not including ``end``.

    A valid trip lies in the month of its file, so the same bounds hold for the partition
    column. Stating them there limits the scan to those folders.
    """
    ts = F.col("tpep_pickup_datetime")
    out = raw.where((ts >= F.lit(start)) & (F.col("source_month") >= F.lit(start.replace(day=1))))
    if end is not None:
        out = out.where((ts < F.lit(end)) & (F.col("source_month") < F.lit(end)))
    return out


def last_pickup_date(spark: SparkSession, fact: tables.State) -> date | None:
    """Newest pickup date of the fact, read from its newest month alone."""
    if not fact.months:
        return None
    return tables.read_state(spark, fact.of([fact.months[-1]])).agg(F.max("pickup_date")).first()[0]


def stage_fact(
    spark: SparkSession,
    raw: tables.State,
    fact: tables.State | None,
    path: str,
    window: tuple[date, date] | None = None,
    *,
    months: list[date] | None = None,
    rules: CleaningRules = CleaningRules(),
    lookback_days: int = 3,
    mode: str = "upsert",
) -> tuple[tables.State, list[date]]:
    """The fact table brought up to date with the raw table, not committed yet, and the months written.

    Without rows in the target everything is built, whatever the window. Otherwise ``months``
    (whole months) or ``window`` (half-open) name the pickups to process, and without either
    the last days of the target are processed again together with everything newer.

    ``mode="replace"`` rebuilds the months as partitions instead of upserting by trip id, so
    fact rows whose raw row has gone disappear too; it takes whole months only.
    """
    if fact is None or not fact.months:
        touched, window = raw.months, None
    elif months is not None:
        touched, window = sorted(months), None
    else:
        if window is None:
            window = last_pickup_date(spark, fact) - timedelta(days=lookback_days), None
        start, end = window
        touched = [m for m in raw.months if m >= start.replace(day=1) and (end is None or m < end)]
    if not touched:
        nothing = fact_rows(stage_trips(tables.read_state(spark, raw.of([])), rules))
        return fact or tables.State(path, tables.evolved_schema(None, nothing.schema)), []
    source = tables.read_state(spark, raw.of(touched))
    staged = stage_trips(in_window(source, *window) if window else source, rules)
    if mode == "replace" and window is None:
        return tables.stage_months(fact_rows(staged, gathered=True), path, touched, fact, gather=False), touched
    return tables.stage_upsert(fact_rows(staged, gathered=True), path, KEY, touched, fact, gather=False), touched


def build_fact(
    spark: SparkSession, raw_path: str, fact_path: str, window: tuple[date, date] | None = None, **options
) -> list[date]:
    """Bring the fact table up to date with the raw table; the months written. Options as of ``stage_fact``."""
    raw = tables.current(spark, raw_path)
    if raw is None:
        raise FileNotFoundError(f"no table at {raw_path}")
    fact, touched = stage_fact(spark, raw, tables.current(spark, fact_path), fact_path, window, **options)
    if touched:
        tables.commit(spark, fact)
    return touched
