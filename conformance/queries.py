"""One query per operator, each over the whole test tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance.feed import CONFIG, RULES, damaged, delivery_path, feed, land, table, zones
from meterline.config import AllowedValues
from meterline.functions import expressions as X
from meterline.operators import checks, marts
from meterline.operators.dims import dim_zones
from meterline.operators.enrich import derive_measures, enrich_trips
from meterline.operators.fact import build_fact, fact_rows, latest_per_key
from meterline.operators.sampling import export_sample, sample_fixed
from meterline.operators.snapshot import rows_as_of
from meterline.operators.staging import drop_counts, stage_trips, stage_zones, type_trips
from meterline.plans import reports, runs
from meterline.plans.data_tests import month_findings
from meterline.session import scratch_path
from meterline.sources import files, tables
from meterline.sources.months import month_name, month_path
from meterline.sources.trips import align_to_schema, load_months
from meterline.sources.zones import read_zones
from meterline.streaming.arrival import ingest_arrivals

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = datetime(2025, 1, 1)
SNAPSHOTS = (datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2025, 3, 1))

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore tells it from the operator's."""
    _queries[function.__name__.rstrip("_")] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# Shared steps.


def rounded(df: DataFrame) -> DataFrame:
    """DOUBLE columns to 6 places: their last digits depend on the order of summation."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(feed(spark, sf_dir), RULES)


def fact(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return fact_rows(staged(spark, sf_dir), **options)


def staged_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_zones(zones(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return marts.trip_cells(fact(spark, sf_dir), list(keys))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_daily_revenue(cells(spark, sf_dir, "pickup_date"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_hourly_demand(cells(spark, sf_dir, "pickup_hour", "pickup_date"))


def zone_board(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    dim = dim_zones(staged_zones(spark, sf_dir))
    return marts.mart_zone_performance(cells(spark, sf_dir, "pickup_location_id"), dim, **options)


def months_of(df: DataFrame) -> list[date]:
    return sorted(row[0] for row in df.select(tables.MONTH).distinct().collect())


def landed(spark: SparkSession, sf_dir: str, **options) -> dict[str, str]:
    """The feed as delivered files: month -> path."""
    folder = land(feed(spark, sf_dir, **options), scratch_path(spark, "landing"))
    months = (month_name(m) for m in months_of(feed(spark, sf_dir, copies=False)))
    return {month: delivery_path(folder, month) for month in months}


def stored_feed(spark: SparkSession, sf_dir: str) -> tuple[str, list[date]]:
    """The feed as a raw table, with its own load times."""
    path, trips = scratch_path(spark, "raw"), feed(spark, sf_dir)
    months = months_of(feed(spark, sf_dir, copies=False))
    tables.write_months(trips, path, months)
    return path, months


# Sources and sinks.


@query
def align_case_and_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_to_schema(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("int").alias("VENDORID"),
            F.col("o_orderdate").alias("TPEP_Pickup_Datetime"),
            (F.col("o_custkey") + F.lit(0.5)).alias("Passenger_Count"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("FARE_AMOUNT"),
            F.col("o_orderstatus").alias("store_and_fwd_FLAG"),
            F.col("o_totalprice").alias("airport_fee"),
            F.col("o_orderpriority").alias("not_in_the_layout"),
        )
    )


@query
def load_month_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    load_months(spark, landed(spark, sf_dir), path, LOADED_AT)
    return tables.read_table(spark, path)


def _month_totals(spark: SparkSession, path: str) -> DataFrame:
    trips = tables.read_table(spark, path).groupBy("source_month")
    return trips.agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(X.cents(F.col("fare_amount"))).alias("fare_cents"),
        F.count("passenger_count").alias("with_passengers"),
    )


@query
def load_month_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month loaded twice."""
    path, deliveries = scratch_path(spark, "raw"), landed(spark, sf_dir)
    for _ in range(2):
        load_months(spark, deliveries, path, LOADED_AT)
    return _month_totals(spark, path)


@query
def load_other_month_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month loaded, then those of one year replaced by a delivery without copies."""
    path = scratch_path(spark, "raw")
    load_months(spark, landed(spark, sf_dir), path, LOADED_AT)
    again = landed(spark, sf_dir, copies=False)
    load_months(spark, {m: p for m, p in again.items() if m.startswith("1998")}, path, LOADED_AT)
    return _month_totals(spark, path)


@query
def load_named_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries where the landing path of their month says, loaded by month alone; rows as the loader counts them."""
    data_dir, landing = scratch_path(spark, "data"), landed(spark, sf_dir)
    for month, path in landing.items():
        files.move(spark, path, month_path(month, data_dir))
    counts = load_months(spark, {m: month_path(m, data_dir) for m in landing}, scratch_path(spark, "raw"), LOADED_AT)
    return spark.createDataFrame(sorted(counts.items()), "month string, rows bigint")


@query
def stage_zones_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup written and read as CSV."""
    path = scratch_path(spark, "zones")
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    zones(spark, sf_dir).write.csv(path, header=True, quoteAll=True, **blanks)
    return stage_zones(read_zones(spark, path))


@query
def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read while it is rebuilt twice: the read that started first sees the first rows."""
    path, trips = scratch_path(spark, "trips"), fact(spark, sf_dir).select("trip_id", "payment_type_name", "source_month")
    tables.overwrite_table(trips, path)
    started = tables.read_table(spark, path)
    for label in ("Cash", "Dispute"):
        tables.overwrite_table(tables.read_table(spark, path).where(F.col("payment_type_name") != label), path)
    seen = started.withColumn("seen", F.lit("first")).unionByName(
        tables.read_table(spark, path).withColumn("seen", F.lit("last"))
    )
    return seen.groupBy("seen", "payment_type_name").agg(F.count(F.lit(1)).alias("trips"))


@query
def upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips stored, then a batch that corrects disputed ones and adds one of each under a new key."""
    path, trips = scratch_path(spark, "fact"), fact(spark, sf_dir, gathered=True)
    months = months_of(feed(spark, sf_dir, copies=False))
    tables.upsert_by_key(trips, path, "trip_id", months, gather=False)
    # Stored rows lie by month already.
    tables.upsert_by_key(_corrections(tables.read_table(spark, path)), path, "trip_id", months, gather=False)
    return rounded(tables.read_table(spark, path))


def _corrections(trips: DataFrame) -> DataFrame:
    disputed = trips.where("payment_type_name = 'Dispute'")
    corrected = disputed.withColumn("tip_amount", F.expr("CAST(tip_amount + 1 AS DECIMAL(10,2))"))
    return corrected.withColumn("trip_id", F.explode(F.array("trip_id", F.concat(F.lit("new-"), "trip_id"))))


@query
def append_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a new column and without one of the old."""
    path, trips = scratch_path(spark, "fact"), fact(spark, sf_dir, gathered=True)
    months = months_of(feed(spark, sf_dir, copies=False))
    tables.upsert_by_key(trips, path, "trip_id", months, gather=False)
    stored = tables.read_table(spark, path)
    batch = _corrections(stored).drop("passenger_count").withColumn("corrected_by", F.lit("desk"))
    tables.upsert_by_key(batch, path, "trip_id", months, gather=False)
    return tables.read_table(spark, path).select(
        "trip_id", "passenger_count", "tip_amount", "source_month", "corrected_by"
    )


@query
def mart_table_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart built twice from stored cells."""
    cell_path, mart_path = scratch_path(spark, "cells"), scratch_path(spark, "daily")
    months = months_of(feed(spark, sf_dir, copies=False))
    tables.write_months(cells(spark, sf_dir, *marts.CELL_KEYS), cell_path, months)
    for _ in range(2):
        tables.overwrite_table(marts.mart_daily_revenue(tables.read_table(spark, cell_path)), mart_path)
    return rounded(tables.read_table(spark, mart_path))


@query
def arrival_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of two landings streamed into the raw table; the second landing has no copies."""
    landing, path = scratch_path(spark, "arrivals"), scratch_path(spark, "raw")
    checkpoint = scratch_path(spark, "seen")
    land(feed(spark, sf_dir), f"{landing}/first")
    ingest_arrivals(spark, landing, path, checkpoint, loaded_at=LOADED_AT, quiet_seconds=0).awaitTermination()
    land(feed(spark, sf_dir, copies=False).where("year(source_month) = 1998"), f"{landing}/second")
    ingest_arrivals(spark, landing, path, checkpoint, loaded_at=LOADED_AT, quiet_seconds=0).awaitTermination()
    return _month_totals(spark, path)


# Staging.


@query
def stage_trips_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


@query
def drop_counts_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_counts(feed(spark, sf_dir), RULES)


@query
def trip_key_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = feed(spark, sf_dir).select(X.trip_key().alias("trip_id"))
    return keys.groupBy("trip_id").agg(F.count(F.lit(1)).alias("copies"))


@query
def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of numbers on both sides of the limits of plain notation."""
    prices = table(spark, sf_dir, "lineitem").withColumn("exponent", F.expr("CAST(l_orderkey % 17 - 6 AS INT)"))
    # The power of ten comes from text, hence is the nearest DOUBLE in any engine.
    scale = F.concat(F.lit("1e"), "exponent").cast("double")
    return prices.select(
        "l_orderkey", "l_linenumber", X.number_text(F.col("l_extendedprice") * scale).alias("amount")
    )


@query
def money_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with three decimals, among them halves of a cent that binary numbers miss."""
    amount = F.col("l_orderkey") / F.lit(1000.0) * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", X.money(amount).alias("amount"))


@query
def stage_zones_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_zones(spark, sf_dir)


@query
def dim_zones_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(staged_zones(spark, sf_dir))


@query
def stage_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a feed with missing values and filled optional amounts."""
    return stage_trips(damaged(feed(spark, sf_dir)), RULES)


@query
def drop_counts_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_counts(damaged(feed(spark, sf_dir)), RULES)


# Derived columns.


@query
def enrich_trips_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enrich_trips(staged(spark, sf_dir), staged_zones(spark, sf_dir)))


@query
def duration_subsecond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes from each event to the next."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    following = events.select((F.col("event_id") - 1).alias("event_id"), F.col("ts").alias("next_ts"))
    minutes = X.duration_minutes(F.col("ts"), F.col("next_ts"))
    return rounded(events.join(following, "event_id").select("event_id", minutes.alias("duration_minutes")))


@query
def speed_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(derive_measures(staged(spark, sf_dir)).select("trip_id", "loaded_at", "avg_speed_mph"))


@query
def tip_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(derive_measures(staged(spark, sf_dir)).select("trip_id", "loaded_at", "tip_pct"))


@query
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.hour(ts).alias("hour"),
        X.iso_weekday(ts).alias("weekday"),
        X.is_weekend(ts).alias("is_weekend"),
        X.month_of(ts).alias("month"),
    )


@query
def payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr("NULLIF(l_linenumber + CAST(l_quantity AS INT) % 3, 9)")
    labelled = table(spark, sf_dir, "lineitem").select(code.alias("code"), X.payment_type_name(code).alias("label"))
    return labelled.groupBy("code", "label").agg(F.count(F.lit(1)).alias("trips"))


# Fact.


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fact(spark, sf_dir))


@query
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First build from the months before 1998 (its window is ignored), then a window of later pickups."""
    raw_path, fact_path = stored_feed(spark, sf_dir)[0], scratch_path(spark, "fact")
    early = scratch_path(spark, "early")
    before = [m for m in tables.stored_months(spark, raw_path) if m < date(1998, 1, 1)]
    tables.write_months(tables.read_table(spark, raw_path).where(tables.in_months(before)), early, before)
    build_fact(spark, early, fact_path, (date(1996, 1, 1), date(1996, 2, 1)), rules=RULES)
    build_fact(spark, raw_path, fact_path, (date(1999, 3, 10), date(2000, 2, 5)), rules=RULES)
    return rounded(tables.read_table(spark, fact_path))


@query
def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built up to 1999, then again over a feed with one passenger more: only the last days and later change."""
    raw_path, months = stored_feed(spark, sf_dir)
    early, later, fact_path = (scratch_path(spark, name) for name in ("early", "later", "fact"))
    trips = tables.read_table(spark, raw_path)
    before = [m for m in months if m < date(2000, 1, 1)]
    # Read from months, written to months: nothing to gather.
    tables.write_months(trips.where(tables.in_months(before)), early, before, gather=False)
    more = trips.withColumn("passenger_count", F.col("passenger_count") + 1)
    tables.write_months(more, later, months, gather=False)
    build_fact(spark, early, fact_path, rules=RULES)
    build_fact(spark, later, fact_path, rules=RULES, lookback_days=3)
    return tables.read_table(spark, fact_path).select("trip_id", "pickup_ts", "passenger_count", "source_month")


# Marts.


@query
def mart_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily(spark, sf_dir))


@query
def mart_hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly(spark, sf_dir))


@query
def mart_zone_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(zone_board(spark, sf_dir))


@query
def mart_zone_performance_many_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart by the way taken for dimensions too large for one window."""
    return rounded(zone_board(spark, sf_dir))


@query
def weighted_tip_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.weighted_tip_overall(cells(spark, sf_dir, "pickup_date")))


# Checks, over trips that are typed but not cleaned so that there are offenders.


def uncleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_trips(feed(spark, sf_dir))


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    offenders = uncleaned(spark, sf_dir).where(checks.is_missing("passenger_count"))
    return offenders.select("trip_id", "payment_type_id", "loaded_at")


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(uncleaned(spark, sf_dir), "trip_id")


@query
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    offenders = uncleaned(spark, sf_dir).where(checks.not_accepted("vendor_id", (1, 2, 6, 7)))
    return offenders.select("trip_id", "vendor_id", "loaded_at")


@query
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = staged_zones(spark, sf_dir).where("borough <> 'AFRICA'")
    return checks.orphan_keys(uncleaned(spark, sf_dir), "dropoff_location_id", known, "location_id")


@query
def check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = derive_measures(uncleaned(spark, sf_dir))
    counts = {
        "duration": checks.out_of_range("duration_minutes", 0, 1440),
        "duration_exclusive": checks.out_of_range("duration_minutes", 0, 1440, inclusive=False),
        "fare": checks.out_of_range("fare_amount", 0, 100_000),
        "speed": checks.out_of_range("avg_speed_mph", high=50),
        "tip": checks.out_of_range("tip_pct", low=0),
    }
    return trips.agg(*(F.count_if(condition).alias(name) for name, condition in counts.items()))


@query
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = feed(spark, sf_dir).agg(F.count(F.lit(1)).alias("trips"))
    return trips.select("trips", (F.col("trips") >= 1).alias("passed"))


@query
def check_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    offenders = uncleaned(spark, sf_dir).where(checks.has_negative_amount())
    return offenders.select("trip_id", "fare_amount", "total_amount", "tip_amount")


@query
def check_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uncleaned(spark, sf_dir).where(checks.ends_before_start()).select("trip_id", "pickup_ts", "dropoff_ts")


@query
def check_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    offenders = derive_measures(uncleaned(spark, sf_dir)).where(checks.has_bad_duration())
    return rounded(offenders.select("trip_id", "pickup_ts", "dropoff_ts", "duration_minutes"))


@query
def reconcile_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart against a fact without its Mondays and with dearer Sundays, one day added."""
    day = F.weekday("pickup_date")
    changed = (
        fact(spark, sf_dir)
        .where(day != 0)
        .withColumn("total_amount", F.expr("CAST(total_amount AS DECIMAL(11,2))") + F.when(day == 6, 1).otherwise(0))
        .withColumn("pickup_date", F.expr("IF(pickup_date = DATE '1998-06-10', DATE '2030-01-01', pickup_date)"))
    )
    return checks.unreconciled_days(changed, daily(spark, sf_dir))


@query
def reconcile_zone_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone mart over a dimension that lacks a region."""
    dim = dim_zones(staged_zones(spark, sf_dir)).where("borough <> 'ASIA'")
    board = marts.mart_zone_performance(cells(spark, sf_dir, "pickup_location_id"), dim)
    return checks.unreconciled_zone_total(fact(spark, sf_dir), board)


@query
def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of NULLs per month in the watched columns."""
    counts = checks.delivery_metrics(feed(spark, sf_dir), fact(spark, sf_dir))
    watched = checks.CRITICAL_COLUMNS + checks.INFO_COLUMNS
    shares = (X.safe_divide(F.col(f"nulls_{c}"), F.col("raw_rows")).alias(c) for c in watched)
    return rounded(counts.select("source_month", *shares))


@query
def delivery_checks_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery gate's verdict where some months lack too many values."""
    trips = damaged(feed(spark, sf_dir))
    months = months_of(feed(spark, sf_dir, copies=False))
    return _verdicts(spark, checks.check_deliveries(trips, fact_rows(stage_trips(trips, RULES)), months, CONFIG.limits))


@query
def findings_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the data tests know of each month, where vendors are missing from the list and trips from the feed."""
    raw, known = damaged(feed(spark, sf_dir)), AllowedValues(vendors=(1, 2, 6, 7), payment_types=(0, 1, 2, 3))
    return month_findings(raw, fact_rows(stage_trips(raw, RULES)), known, RULES)


@query
def delivery_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery gate's verdict on every month, as rows."""
    trips, months = feed(spark, sf_dir), months_of(feed(spark, sf_dir, copies=False))
    return _verdicts(spark, checks.check_deliveries(trips, fact(spark, sf_dir), months, CONFIG.limits))


def _verdicts(spark: SparkSession, results: dict[str, list[checks.CheckResult]]) -> DataFrame:
    rows = [(month, r.name, r.passed, r.detail) for month, every in results.items() for r in every]
    return spark.createDataFrame(rows, "month string, name string, passed boolean, detail string")


# History.


def _renamed(rows: DataFrame, version: int) -> DataFrame:
    """The lookup at a later moment: some zones renamed, some moved to NULL, some gone, some new."""
    key, v = F.col("location_id"), version
    return (
        rows.where(key % 11 != v)
        .withColumn("zone", F.when(key % 5 == v, F.concat("zone", F.lit(f" v{v}"))).otherwise(F.col("zone")))
        .withColumn("service_zone", F.when(key % 7 < 2, None).otherwise(F.col("service_zone")))
        .withColumn("location_id", F.when(key % 13 == v, key + 1_000_000 * v).otherwise(key))
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots, each stored and read back."""
    warehouse, first = runs.Warehouse(scratch_path(spark, "history")), staged_zones(spark, sf_dir)
    states: runs.States = {}
    for version, at in enumerate(SNAPSHOTS):
        rows = first if version == 0 else _renamed(first, version)
        states["history"] = runs.stage_history(spark, warehouse, states, rows, at)
        tables.commit(spark, states["history"])
    return tables.read_table(spark, warehouse.history)


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_as_of(_history(spark, sf_dir), datetime(2025, 2, 15)).select(
        "location_id", "borough", "zone", "service_zone"
    )


# Reports.


@query
def report_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.daily_revenue_series(daily(spark, sf_dir)))


@query
def report_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.daily_revenue_extremes(daily(spark, sf_dir)))


@query
def report_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.busiest_zones(zone_board(spark, sf_dir))


@query
def report_tip_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.tip_by_hour(hourly(spark, sf_dir)))


@query
def sample_files_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample by file and place, exported and read back."""
    target = scratch_path(spark, "sample")
    export_sample(spark, f"{sf_dir}/lineitem.parquet", target, 500)
    return spark.read.parquet(target)


@query
def sample_fixed_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_fixed(table(spark, sf_dir, "orders"), 200, ["o_orderkey"])


# Runs.


@query
def audited_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months in order with every check enforced: what is published when the first month that fails has stopped it."""
    deliveries, lookup = landed(spark, sf_dir), zones(spark, sf_dir)
    warehouse, config = runs.Warehouse(scratch_path(spark, "warehouse")), replace(CONFIG, enforce=True)
    try:
        runs.run_months(spark, sorted(deliveries), "", warehouse, lookup, config, paths=deliveries, at=LOADED_AT)
    except checks.DataQualityError as error:
        log.info("stopped: %s", error)
    published = warehouse.snapshot(spark)
    if not published:
        return spark.createDataFrame([], "source_month date, raw_rows bigint, trips bigint")
    raw = tables.read_state(spark, published["raw"]).groupBy("source_month").agg(F.count(F.lit(1)).alias("raw_rows"))
    daily_mart = tables.read_state(spark, published["mart_daily_revenue"])
    by_month = daily_mart.groupBy(F.trunc("pickup_date", "month").alias("source_month"))
    return raw.join(by_month.agg(F.sum("trip_count").alias("trips")), "source_month", "full_outer")


@query
def run_months_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later months first, then the earlier ones together with one later year again; the state per month."""
    deliveries = landed(spark, sf_dir)
    warehouse, lookup = runs.Warehouse(scratch_path(spark, "warehouse")), zones(spark, sf_dir)
    months = sorted(deliveries)
    half = len(months) // 2
    for part in (months[half:], [m for m in months[half:] if m.startswith("1999")] + months[:half]):
        runs.run_months(spark, part, "", warehouse, lookup, CONFIG, paths=deliveries, at=LOADED_AT)
    raw = tables.read_table(spark, warehouse.raw).groupBy("source_month").agg(F.count(F.lit(1)).alias("raw_rows"))
    by_month = tables.read_table(spark, warehouse.mart("mart_daily_revenue")).groupBy(
        F.trunc("pickup_date", "month").alias("source_month")
    )
    state = by_month.agg(
        F.sum("trip_count").alias("trips"),
        F.sum(F.col("total_revenue").cast("decimal(28,2)")).cast("decimal(38,2)").alias("revenue"),
    )
    return raw.join(state, "source_month", "full_outer")
