import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterline.config import AllowedValues, DeliveryLimits, RunConfig
from meterline.operators.checks import DataQualityError
from meterline.operators.snapshot import VALID_TO, apply_snapshot, current_rows, rows_as_of
from meterline.plans import reports, runs
from meterline.sources import tables
from meterline.sources.zones import read_zones
from meterline.streaming.arrival import ingest_arrivals
from tests.test_safety import lost_at, tried

CONFIG = RunConfig(limits=DeliveryLimits(min_rows=100))
AT = datetime(2025, 4, 1)


@pytest.fixture
def zones(spark, zone_csv):
    return read_zones(spark, zone_csv)


@pytest.fixture
def warehouse(tmp_path):
    return runs.Warehouse(f"{tmp_path}/warehouse")


def state(spark, warehouse):
    out = {}
    for name, path in [("raw", warehouse.raw), ("fact", warehouse.fact)] + [
        (m, warehouse.mart(m)) for m in (*runs.MARTS, "dim_zones")
    ]:
        df = tables.read_table(spark, path)
        out[name] = sorted(map(str, df.select(*(F.round(c, 6) if t == "double" else c for c, t in df.dtypes)).collect()))
    return out


def test_a_run_builds_everything_and_passes(spark, deliver, zones, warehouse, tmp_path):
    deliver("2025-01")
    report = runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=CONFIG, at=AT)
    assert report.loaded == {"2025-01": 300}
    assert len(report.tests) == 52 and not report.failures
    assert [r.name for r in report.deliveries["2025-01"]][-1] == "fct_trips_retention"
    assert {k: len(v) for k, v in state(spark, warehouse).items()} == {
        "raw": 300,
        "fact": 300,
        "mart_daily_revenue": 2,
        "mart_hourly_demand": 24,
        "mart_zone_performance": 3,
        "dim_zones": 5,
    }
    assert tables.read_table(spark, warehouse.history).count() == 5


def test_order_batching_and_repetition_do_not_matter(spark, deliver, zones, tmp_path):
    months = ["2025-01", "2025-02"]
    for month in months:
        deliver(month, 120)
    states = []
    for name, steps, config in (
        ("together", [months], CONFIG),
        ("one by one", [["2025-02"], ["2025-01"], ["2025-02"]], CONFIG),
        ("no sharing", [months[::-1]], RunConfig(limits=CONFIG.limits, batch_bytes=0)),
        ("replace", [["2025-02"], months], RunConfig(limits=CONFIG.limits, fact_mode="replace")),
    ):
        warehouse = runs.Warehouse(f"{tmp_path}/{name}")
        for step in steps:
            runs.run_months(spark, step, str(tmp_path), warehouse, zones, config, at=AT)
        states.append(state(spark, warehouse))
    assert states[0] == states[1] == states[2] == states[3]


def test_failing_data_tests_stop_the_run(spark, deliver, zones, warehouse, tmp_path):
    deliver("2025-01")
    strict = RunConfig(limits=CONFIG.limits, allowed=AllowedValues(vendors=(2,)))
    with pytest.raises(DataQualityError, match=r"1 data quality.*stg_trips.accepted_values\[vendor_id\] -> 300 offending"):
        runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=strict)


def test_unknown_zones_are_reported(spark, deliver, zones, warehouse, tmp_path):
    deliver("2025-01", change=lambda df: df.withColumn("PULocationID", F.lit(77)))
    relaxed = RunConfig(limits=CONFIG.limits, enforce=False)
    report = runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=relaxed)
    assert {r.name for r in report.failures} == {
        "stg_trips.relationships[pickup_location_id]",
        "fct_trips.relationships[pickup_location_id]",
        "zone_trips_sum_to_fct",
    }


def test_a_poor_delivery_fails_the_run(spark, deliver, zones, warehouse, tmp_path):
    deliver("2025-01", 50)
    deliver("2025-02", 200)
    with pytest.raises(DataQualityError, match=r"failed for 2025-01: raw_row_count -> 50 rows \(minimum 100\)"):
        runs.run_months(spark, ["2025-01", "2025-02"], str(tmp_path), warehouse, zones, CONFIG)


def test_a_poor_month_leaves_no_trace_and_later_ones_wait(spark, deliver, zones, warehouse, tmp_path):
    for month, n in (("2025-01", 150), ("2025-02", 50), ("2025-03", 150)):
        deliver(month, n)
    with pytest.raises(DataQualityError, match="1 data quality.* failed for 2025-02: raw_row_count -> 50"):
        runs.run_months(spark, ["2025-01", "2025-02", "2025-03"], str(tmp_path), warehouse, zones, CONFIG, at=AT)
    january = date(2025, 1, 1)
    for path in (warehouse.raw, warehouse.fact, warehouse.cells, warehouse.findings):
        assert tables.stored_months(spark, path) == [january]
    assert tables.read_table(spark, warehouse.mart("mart_daily_revenue")).where("pickup_date >= '2025-02-01'").isEmpty()
    published = state(spark, warehouse)
    with pytest.raises(DataQualityError, match="failed for 2025-02"):
        runs.run_months(spark, ["2025-02", "2025-03"], str(tmp_path), warehouse, zones, CONFIG, at=AT)
    assert state(spark, warehouse) == published
    report = runs.run_months(spark, ["2025-01", "2025-03"], str(tmp_path), warehouse, zones, CONFIG, at=AT)
    assert report.loaded == {"2025-01": 150, "2025-03": 150} and len(report.tests) == 52


def test_a_redelivery_that_fails_keeps_the_published_rows(spark, deliver, zones, warehouse, tmp_path):
    deliver("2025-01", 150)
    runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=CONFIG, at=AT)
    published = state(spark, warehouse)
    deliver("2025-01", 150, change=lambda df: df.withColumn("PULocationID", F.lit(77)))
    with pytest.raises(DataQualityError, match="failed for 2025-01"):
        runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=CONFIG, at=AT)
    assert state(spark, warehouse) == published


def test_a_driver_lost_at_any_step_publishes_all_tables_or_none(spark, deliver, zones, tmp_path, monkeypatch):
    deliver("2025-01", 150)
    deliver("2025-02", 150, "later/raw")
    ways = set()
    warehouse = runs.Warehouse(f"{tmp_path}/w")
    runs.run_month(spark, "2025-01", str(tmp_path), warehouse, zones, config=CONFIG, at=AT)
    before = warehouse.opened(spark)
    months = {"raw": 2, "fact": 2, "cells": 2, "findings": 2}
    # Writing the warehouse's version and renaming it, then the tables' own versions, then clearing up.
    for step in (1, 2, 3, 12, 1000):
        copy = runs.Warehouse(f"{tmp_path}/copy{step}")
        shutil.copytree(warehouse.root, copy.root)
        with lost_at(monkeypatch, step):
            done = tried(
                lambda: runs.run_month(spark, "2025-02", f"{tmp_path}/later", copy, zones, config=CONFIG, at=AT)
            )
        seen = {name: len(s.months) for name, s in copy.snapshot(spark).items() if name in months}
        assert seen in ({name: 1 for name in months}, months)
        ways.add(seen == months)
        states = copy.opened(spark)
        assert {name: len(states[name].months) for name in months} == seen
        days = tables.read_state(spark, states["mart_daily_revenue"]).agg(F.max("pickup_date")).first()[0]
        assert (days.month == 2) == (seen == months)
    assert done and ways == {True, False} and before.keys() == states.keys()


def test_answers_from_findings_equal_those_from_whole_tables(spark, raw_of, zones, warehouse):
    from meterline.operators import checks
    from meterline.operators.enrich import derive_measures
    from meterline.operators.fact import fact_rows
    from meterline.operators.staging import stage_trips, stage_zones
    from meterline.plans.data_tests import month_findings, results_by_month, table_tests
    from tests.conftest import trip

    def at(month, minute, **changes):
        start = datetime(2025, month, 3, 8, minute)
        return trip(
            tpep_pickup_datetime=start, tpep_dropoff_datetime=start.replace(hour=9), source_month=date(2025, month, 1), **changes
        )

    raw = raw_of(
        *(at(1, i, VendorID=i % 9, PULocationID=i % 4) for i in range(30)),
        *(at(2, i, payment_type=i % 9, DOLocationID=i % 5, fare_amount=-1.0 if i % 7 == 0 else 5.0) for i in range(30)),
    )
    staged, suite, staged_zones = stage_trips(raw), table_tests(), stage_zones(zones)
    fact = fact_rows(staged)
    fact = fact.unionByName(fact.where("pickup_hour = 8 AND source_month = '2025-02-01'"))  # ids that repeat
    findings = month_findings(raw, fact)
    own = {"stg_trips": staged, "int_trips": derive_measures(staged), "fct_trips": fact}
    got = {(r.kind, r.key): r.n for r in findings.groupBy("kind", "key").agg(F.sum("n").alias("n")).collect()}
    for table, df in own.items():
        for name, n in checks.count_offenders(df, suite[table].rows).items():
            assert got.get(("offenders", f"{table}.{name}"), 0) == n, name
    assert got["repeated", "fct_trips.trip_id"] == checks.duplicate_keys(fact, "trip_id").count() > 0
    assert got["rows", "raw_trips"] == 60 and got["rows", "fct_trips"] == fact.count()
    parents = {"stg_zones": staged_zones, "dim_zones": staged_zones}
    months = [date(2025, 1, 1), date(2025, 2, 1), date(2025, 3, 1)]
    tests, deliveries = results_by_month(findings, parents, months)
    for table in ("stg_trips", "fct_trips"):
        for column, _, parent_column in suite[table].references:
            for month in months[:2]:
                lost = checks.orphan_keys(own[table].where(F.col("source_month") == month), column, staged_zones, parent_column)
                result = next(r for r in tests[month] if r.name == f"{table}.relationships[{column}]")
                assert result.detail == f"{lost.count():,} offending keys"
    assert {f"{m:%Y-%m}": results for m, results in deliveries.items()} == checks.check_deliveries(raw, fact, months)


def test_only_months_with_new_rows_or_settings_are_looked_at_again(spark, deliver, zones, warehouse, tmp_path):
    for month in ("2025-01", "2025-02"):
        deliver(month, 150)
    runs.run_months(spark, ["2025-01", "2025-02"], str(tmp_path), warehouse, zones, CONFIG, at=AT)
    first = {p.month: p for p in warehouse.opened(spark)["findings"].parts}
    runs.run_month(spark, "2025-02", str(tmp_path), warehouse, zones, config=CONFIG, at=AT)
    second = {p.month: p for p in warehouse.opened(spark)["findings"].parts}
    assert first[date(2025, 1, 1)] == second[date(2025, 1, 1)] and first[date(2025, 2, 1)] != second[date(2025, 2, 1)]
    other = RunConfig(limits=CONFIG.limits, allowed=AllowedValues(vendors=(1, 2)))
    runs.run_month(spark, "2025-02", str(tmp_path), warehouse, zones, config=other, at=AT)
    third = {p.month: p for p in warehouse.opened(spark)["findings"].parts}
    assert third[date(2025, 1, 1)].folder != second[date(2025, 1, 1)].folder


def test_bad_month_fails_before_anything_is_written(spark, zones, warehouse, tmp_path):
    with pytest.raises(ValueError, match="YYYY-MM"):
        runs.run_month(spark, "2025-1", str(tmp_path), warehouse, zones)
    assert not tables.table_exists(spark, warehouse.raw)


def test_batches_respect_the_size():
    sizes = {"a": 5, "b": 5, "c": 20, "d": 1, "e": 1}
    assert list(runs._batches(sizes, 10)) == [["a", "b"], ["c"], ["d", "e"]]


# History.


def zone_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "location_id int, borough string, zone string, service_zone string")


def test_history(spark):
    days = [datetime(2025, m, 1) for m in (1, 2, 3)]
    history = apply_snapshot(None, zone_rows(spark, (1, "A", "x", None), (2, "A", "y", "s"), (3, "B", "z", "s")), days[0])
    # 1 stays with its NULL, 2 is renamed, 3 disappears, 4 is new.
    history = apply_snapshot(history, zone_rows(spark, (1, "A", "x", None), (2, "A", "Y", "s"), (4, "C", "w", "s")), days[1])
    history = apply_snapshot(history, zone_rows(spark, (1, "A", "x", "s"), (2, "A", "Y", "s"), (4, "C", "w", "s")), days[2])
    spells = sorted((r.location_id, r.dbt_valid_from, r[VALID_TO], r.zone) for r in history.collect())
    assert [(k, f.month, t and t.month, z) for k, f, t, z in spells] == [
        (1, 1, 3, "x"),
        (1, 3, None, "x"),
        (2, 1, 2, "y"),
        (2, 2, None, "Y"),
        (3, 1, None, "z"),
        (4, 2, None, "w"),
    ]
    assert history.select("dbt_scd_id").distinct().count() == 6
    assert current_rows(history).count() == 4
    assert rows_as_of(history, days[1]).where("location_id = 2").first().zone == "Y"
    assert rows_as_of(history, datetime(2025, 1, 31)).where("location_id = 2").first().zone == "y"
    assert rows_as_of(history, datetime(2024, 12, 31)).count() == 0


def test_closed_spells_stay_in_their_files(spark, tmp_path):
    warehouse, states, plain = runs.Warehouse(f"{tmp_path}/w"), {}, None
    versions = [
        [(1, "A", "x", None), (2, "A", "y", "s"), (3, "B", "z", "s")],
        [(1, "A", "x", None), (2, "A", "Y", "s"), (4, "C", "w", "s")],
        [(1, "A", "X", None), (2, "A", "Y", "s"), (4, "C", "w", "t")],
        [(1, "A", "X", None), (2, "A", "Y", "s"), (4, "C", "w", "t")],
    ]
    closed: list[set] = []
    for month, rows in enumerate(versions, 1):
        source, at = zone_rows(spark, *rows), datetime(2025, month, 1)
        states["history"] = runs.stage_history(spark, warehouse, states, source, at)
        plain = apply_snapshot(plain, source, at)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        closed.append({p.folder for p in states["history"].parts if p.note == "closed"})
    assert closed[0] == set() and closed[1] < closed[2] == closed[3] and len(closed[3]) == 2
    got = tables.read_state(spark, states["history"])
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


# Reports.


def test_reports_settle_ties_and_tolerate_gaps(spark):
    daily = spark.createDataFrame(
        [(date(2025, 1, d), v) for d, v in ((1, 5), (2, 9), (3, 9), (4, 5))], "pickup_date date, total_revenue int"
    ).withColumn("total_revenue", F.col("total_revenue").cast("decimal(38,2)"))
    rows = {r.extreme: r for r in reports.daily_revenue_extremes(daily).collect()}
    assert (rows["peak"].pickup_date.day, rows["low"].pickup_date.day) == (2, 1)
    assert (rows["all"].days, rows["all"].revenue_musd) == (4, 28e-6)
    hourly = spark.createDataFrame([(5, 18.0), (18, 24.0), (20, None)], "pickup_hour int, weighted_tip_pct double")
    marks = {r.pickup_hour: r.extreme for r in reports.tip_by_hour(hourly).collect()}
    assert marks == {5: "lowest", 18: "highest", 20: None}


# Arrival.


def test_arrivals_are_loaded_once_and_redeliveries_replace(spark, deliver, tmp_path, warehouse):
    seen: list[dict] = []

    def ingest():
        query = ingest_arrivals(
            spark, f"{tmp_path}/landing", warehouse.raw, f"{tmp_path}/seen", loaded_at=AT, on_loaded=seen.append
        )
        query.awaitTermination()

    deliver("2025-01", 30, "landing/first")
    deliver("2025-02", 40, "landing/first", change=lambda df: df.withColumn("passenger_count", F.lit(1.0)))
    ingest()
    ingest()
    assert seen == [{"2025-01": 30, "2025-02": 40}]
    deliver("2025-01", 35, "landing/second")
    ingest()
    assert seen[1:] == [{"2025-01": 35}]
    assert tables.row_count(spark, warehouse.raw, date(2025, 1, 1)) == 35
    assert tables.row_count(spark, warehouse.raw, date(2025, 2, 1)) == 40


def test_a_month_spread_over_batches_is_loaded_once(spark, deliver, tmp_path, warehouse):
    path = deliver("2025-01", 30, "landing")
    spark.read.parquet(path).limit(10).write.mode("append").parquet(path)
    seen: list[dict] = []
    ingest_arrivals(
        spark, f"{tmp_path}/landing", warehouse.raw, f"{tmp_path}/seen", on_loaded=seen.append, max_files=1
    ).awaitTermination()
    assert seen[0] == {"2025-01": 40} and len(seen) <= 2  # again only for a file newer than those of the first batch
    assert tables.row_count(spark, warehouse.raw, date(2025, 1, 1)) == 40


def test_a_half_landed_folder_waits_for_its_marker_or_quiet_time(spark, deliver, tmp_path, warehouse):
    seen: list[dict] = []

    def ingest(**options):
        ingest_arrivals(
            spark, f"{tmp_path}/landing", warehouse.raw, f"{tmp_path}/seen", on_loaded=seen.append, **options
        ).awaitTermination()

    path = deliver("2025-01", 30, "landing")
    os.remove(f"{path}/_SUCCESS")
    ingest()
    assert seen == [] and not tables.table_exists(spark, warehouse.raw)
    # The rest lands, then the marker; nothing is loaded twice.
    for file in [f for f in os.listdir(deliver("2025-01", 12, "rest")) if f.endswith(".parquet")]:
        shutil.copy(f"{tmp_path}/rest/yellow_tripdata_2025-01.parquet/{file}", path)
    ingest()
    assert seen == []
    open(f"{path}/_SUCCESS", "w").close()
    ingest()
    ingest()
    assert seen == [{"2025-01": 42}]
    # Without a marker, time tells; a late file brings the month in again.
    quiet = deliver("2025-02", 20, "landing")
    os.remove(f"{quiet}/_SUCCESS")
    ingest(quiet_seconds=0)
    for file in [f for f in os.listdir(deliver("2025-02", 5, "late")) if f.endswith(".parquet")]:
        shutil.copy(f"{tmp_path}/late/yellow_tripdata_2025-02.parquet/{file}", quiet)
    ingest(quiet_seconds=0)
    assert seen[1:] == [{"2025-02": 20}, {"2025-02": 25}]
