"""What is shuffled and written: each row once for each step that needs it."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conformance.queries import all_queries
from meterline.operators.fact import fact_rows
from meterline.plans import data_tests
from meterline.sources import tables
from tests.conftest import trip

JANUARY, FEBRUARY = date(2025, 1, 1), date(2025, 2, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """Plans and ``gather`` of the writes by month."""
    calls, write = [], tables._written_months

    def spy(df, path, months, gather):
        calls.append((plan_of(df), gather))
        return write(df, path, months, gather)

    monkeypatch.setattr(tables, "_written_months", spy)
    return calls


@pytest.fixture
def lineitems(spark, tmp_path):
    """A table of line items from 1998 to 2000, five of each day."""
    first = datetime(1998, 1, 1)
    rows = [
        (i, i % 40 + 1, i % 9 + 1, i % 6 + 1, float(i % 30 + 1), 100.0 + i, 0.05, 0.02, "N", first + timedelta(days=i // 5))
        for i in range(4000)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    names += "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    return f"{tmp_path}/in"


def test_old_rows_are_shuffled_once_for_the_join_and_their_files(spark, tmp_path, written, monkeypatch):
    monkeypatch.setattr(tables, "PIECE_BYTES", 400, raising=False)
    old = spark.range(3000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"), F.when(F.col("id") % 3 == 0, JANUARY).otherwise(FEBRUARY).alias("source_month")
    )
    path, months = f"{tmp_path}/t", [JANUARY, FEBRUARY]
    tables.upsert_by_key(old, path, "k", months)
    batch = old.where("CAST(substring(k, 2) AS INT) % 10 = 0").withColumn("v", F.lit(2)).withColumn("w", F.lit("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables.upsert_by_key(batch, path, "k", months)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan, gather = written[-1]
    # The one exchange that Spark adds is that of the distinct keys; nothing is gathered afterwards.
    assert plan.count("ENSURE_REQUIREMENTS") == 1 and not gather
    got = {tuple(r) for r in tables.read_table(spark, path).select("k", "v", "source_month", "w").collect()}
    want = {(f"k{i}", 1 + (i % 10 == 0), FEBRUARY if i % 3 else JANUARY, None if i % 10 else "x") for i in range(3000)}
    assert got == want


@pytest.mark.parametrize("name", ["upsert_fact", "append_new_columns"])
def test_corrections_come_from_the_stored_trips(spark, lineitems, written, name):
    all_queries()[name](spark, lineitems)
    ranked = [plan for plan, _ in written if "Window" in plan]
    assert len(written) == 3 and len(ranked) == 1 and not any(gather for _, gather in written)


def test_months_read_from_months_are_not_gathered(spark, lineitems, written):
    all_queries()["incremental_lookback"](spark, lineitems)
    # The feed alone is; trips of the fact are gathered before their derived columns.
    assert [gather for _, gather in written].count(True) == 1


def test_fact_keys_are_shuffled_as_bytes(spark, raw_of):
    from meterline.operators.staging import stage_trips

    staged = stage_trips(raw_of(trip(), trip(loaded_at=datetime(2025, 2, 2)), trip(fare_amount=9.0)))
    keys = {r.trip_id for r in staged.select("trip_id").collect()}
    rows = fact_rows(staged, gathered=True)
    assert {r.trip_id for r in rows.collect()} == keys and rows.count() == 2
    assert "unhex" in plan_of(rows) and re.search("Exchange hashpartitioning.*REBALANCE", plan_of(rows))


def test_ids_are_counted_column_by_column(spark):
    rows = [(JANUARY, i % 50, i % 49, i % 2) for i in range(2450)] + [(FEBRUARY, None, 7, 1)]
    table = spark.createDataFrame(rows, "source_month date, a int, b int, c int")
    found = data_tests._counts(table, {("offenders", "t.odd"): F.count_if(F.col("c") == 1)}, {"t.a": "a", "t.b": "b"})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^\]]*\ba#\d+, b#\d+", plan)
    got = {(r.source_month, r.kind, r.key, r.value): r.n for r in found.collect()}
    assert got.pop((JANUARY, "offenders", "t.odd", None)) == 1225 and got.pop((FEBRUARY, "offenders", "t.odd", None)) == 1
    assert got.pop((FEBRUARY, "ids", "t.b", "7")) == 1
    want = {(JANUARY, "ids", "t.a", str(i)): 49 for i in range(50)} | {(JANUARY, "ids", "t.b", str(i)): 50 for i in range(49)}
    assert got == want
