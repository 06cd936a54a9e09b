from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.config import CleaningRules
from meterline.operators import marts
from meterline.operators.dims import dim_zones
from meterline.operators.enrich import derive_measures, enrich_trips
from meterline.operators.fact import FACT_COLUMNS, fact_rows, latest_per_key
from meterline.operators.staging import REQUIRED, drop_counts, stage_trips, stage_zones
from meterline.sources.zones import read_zones
from tests.conftest import trip

PICKUP = datetime(2025, 1, 15, 8, 0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("column", REQUIRED)
def test_required_columns(raw_of, column):
    assert stage_trips(raw_of(trip(**{column: None}))).count() == 0


@pytest.mark.parametrize(
    ("changes", "kept"),
    [
        ({}, True),
        ({"fare_amount": -0.01}, False),
        ({"fare_amount": -0.004}, True),
        ({"total_amount": -0.01}, False),
        ({"tip_amount": -0.01}, False),
        ({"trip_distance": -0.1}, False),
        ({"trip_distance": None}, False),
        ({"trip_distance": float("nan")}, False),
        ({"tip_amount": float("nan")}, False),
        ({"fare_amount": 1000.0}, True),
        ({"fare_amount": 1000.004}, True),
        ({"fare_amount": 1000.01}, False),
        ({"total_amount": 1000.01}, False),
        ({"trip_distance": 200.0}, True),
        ({"trip_distance": 200.01}, False),
        ({"tpep_dropoff_datetime": PICKUP}, True),
        ({"tpep_dropoff_datetime": PICKUP - timedelta(seconds=1)}, False),
        ({"tpep_dropoff_datetime": PICKUP + timedelta(hours=24)}, False),
        ({"tpep_dropoff_datetime": PICKUP + timedelta(hours=24, seconds=-1)}, True),
        ({"source_month": date(2025, 2, 1)}, False),
        ({"PULocationID": 999}, True),
        ({"payment_type": None}, True),
    ],
)
def test_cleaning_rules(raw_of, changes, kept):
    raw = raw_of(trip(**changes))
    assert stage_trips(raw).count() == kept
    assert drop_counts(raw).first()["kept"] == kept


def test_caps_are_parameters(raw_of):
    raw = raw_of(trip(fare_amount=5000.0))
    assert stage_trips(raw, CleaningRules(max_fare_usd=5000)).count() == 1


def test_missing_extras_become_zero_but_not_fares(raw_of):
    raw = raw_of(trip(extra=None, tolls_amount=None, Airport_fee=None, cbd_congestion_fee=None, mta_tax=0.5))
    row = stage_trips(raw).first()
    assert (row.extra_amount, row.tolls_amount, row.airport_fee_amount, row.cbd_congestion_fee_amount) == (0,) * 4
    assert row.mta_tax_amount == Decimal("0.50")
    assert len(row) == 23


def test_staging_reaches_the_scan(spark, raw_of, tmp_path):
    raw_of(trip()).write.partitionBy("source_month").parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw").where(F.col("source_month") == date(2025, 1, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(stage_trips(raw).select("pickup_ts", "fare_amount"))
    assert "PartitionFilters: [isnotnull(source_month" in plan
    assert "LessThanOrEqual(trip_distance,200.0)" in plan
    assert "store_and_fwd_flag" not in plan


@pytest.mark.parametrize("model", [stage_trips, lambda raw: fact_rows(stage_trips(raw))])
def test_generated_loops_are_small_enough_for_java_to_compile(spark, raw_of, tmp_path, model):
    raw_of(trip()).write.parquet(f"{tmp_path}/raw")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = model(spark.read.parquet(f"{tmp_path}/raw"))._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000


def test_zones(spark, zone_csv):
    zones = stage_zones(read_zones(spark, zone_csv))
    rows = {r.location_id: r for r in dim_zones(zones).collect()}
    assert rows[2].zone == "Jamaica Bay"
    assert rows[264].zone == "N/A" and rows[265].borough == "N/A"
    assert [rows[i].is_airport for i in (1, 2, 3)] == [True, False, False]
    assert [rows[i].is_manhattan for i in (1, 2, 3)] == [False, False, True]


def test_unknown_zones_keep_the_trip(spark, raw_of, zone_csv):
    staged = stage_trips(raw_of(trip(PULocationID=3, DOLocationID=999)))
    row = enrich_trips(staged, stage_zones(read_zones(spark, zone_csv))).first()
    assert (row.pickup_borough, row.pickup_zone) == ("Manhattan", "Alphabet City")
    assert (row.dropoff_borough, row.dropoff_zone) == (None, None)
    assert len(row) == 30


def test_fact_columns_and_derived_values(raw_of):
    saturday = trip(
        tpep_pickup_datetime=datetime(2025, 1, 18, 23, 59), tpep_dropoff_datetime=datetime(2025, 1, 19, 0, 29)
    )
    fact = fact_rows(stage_trips(raw_of(saturday)))
    assert fact.columns == FACT_COLUMNS
    row = fact.first()
    assert (row.pickup_date, row.pickup_hour, row.pickup_day_of_week, row.is_weekend) == (date(2025, 1, 18), 23, 6, True)
    assert (row.duration_minutes, row.avg_speed_mph, row.tip_pct) == (30.0, 10.0, 20.0)
    assert row.payment_type_name == "Credit card"


def test_latest_copy_wins_and_ties_are_settled(raw_of):
    rows = [trip(passenger_count=n, loaded_at=datetime(2025, 2, d)) for n, d in ((1, 1), (2, 3), (3, 2), (None, 3))]
    for order in (rows, rows[::-1]):
        kept = fact_rows(stage_trips(raw_of(*order))).collect()
        assert [r.passenger_count for r in kept] == [2]


def test_copies_are_dropped_before_the_shuffle(spark):
    hot = (F.col("id") % 1).cast("string")
    df = spark.range(1000).select(hot.alias("k"), F.col("id").alias("v"), (F.col("id") % 1).alias("t"))
    latest = latest_per_key(df.repartition(4), ["k"], "t")
    plan = plan_of(latest)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert latest.collect() == [("0", 999, 0)]


@pytest.fixture
def fact(raw_of):
    rows = [
        trip(
            tpep_pickup_datetime=PICKUP + timedelta(hours=5 * i),
            tpep_dropoff_datetime=PICKUP + timedelta(hours=5 * i, minutes=10 + i),
            PULocationID=(1, 2, 2, 3, 999)[i % 5],
            payment_type=1 + i % 2,
            fare_amount=10.0 + i,
        )
        for i in range(40)
    ]
    return fact_rows(stage_trips(raw_of(*rows))).cache()


def test_marts_from_cells_equal_marts_from_the_fact(fact):
    def rows(df):
        rounded = [F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]
        return sorted(map(str, df.select(*rounded).collect()))

    cells = marts.trip_cells(fact)
    direct = fact.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total_revenue"),
        F.avg("trip_distance_miles").alias("avg_trip_distance_miles"),
        F.avg("tip_pct").alias("avg_tip_pct"),
    )
    assert rows(marts.mart_daily_revenue(cells).select(*direct.columns)) == rows(direct)
    direct = fact.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.countDistinct("pickup_date").alias("days_observed"),
        F.avg("fare_amount").cast("double").alias("avg_fare"),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
    )
    assert rows(marts.mart_hourly_demand(cells).select(*direct.columns)) == rows(direct)


def test_zone_mart_leaves_out_unknown_zones(spark, fact, zone_csv):
    dim = dim_zones(stage_zones(read_zones(spark, zone_csv)))
    cells = marts.trip_cells(fact)
    board = {r.location_id: r for r in marts.mart_zone_performance(cells, dim).collect()}
    assert board.keys() == {1, 2, 3}
    assert [board[i].trip_count_rank for i in (2, 1, 3)] == [1, 2, 2]
    assert [board[i].pct_of_all_trips for i in (2, 1, 3)] == [50.0, 25.0, 25.0]
    many = marts.mart_zone_performance(cells, dim)
    assert {r.location_id: r for r in many.collect()} == board
    assert marts.mart_zone_performance(cells, dim).dtypes == many.dtypes


def test_weighted_tip_counts_card_trips_only(fact):
    row = marts.weighted_tip_overall(marts.trip_cells(fact, ["pickup_date"])).first()
    card = [10.0 + i for i in range(0, 40, 2)]
    assert row.weighted_tip_pct == pytest.approx(100 * 4 * len(card) / sum(card))
    assert row.avg_tip_pct == pytest.approx(sum(400 / f for f in card) / len(card))


def test_measures_without_names_need_no_join(raw_of):
    assert "Join" not in plan_of(derive_measures(stage_trips(raw_of(trip()))))
