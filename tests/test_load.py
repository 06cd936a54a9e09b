from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterline.sources import tables
from meterline.sources.schemas import AUDIT_COLUMNS, RAW_COLUMNS
from meterline.sources.trips import align_to_schema, load_month, load_months

JANUARY, FEBRUARY = date(2025, 1, 1), date(2025, 2, 1)


@pytest.fixture
def table(tmp_path):
    return f"{tmp_path}/warehouse/raw"


def test_rerun_gives_the_same_table(spark, deliver, table):
    path = deliver("2025-01")
    assert load_month(spark, path, "2025-01", table) == load_month(spark, path, "2025-01", table) == 300
    assert tables.row_count(spark, table, JANUARY) == 300


def test_other_months_stay(spark, deliver, table):
    january, february = deliver("2025-01"), deliver("2025-02", 200)
    load_month(spark, january, "2025-01", table)
    load_month(spark, february, "2025-02", table)
    load_month(spark, deliver("2025-01", 50, "again"), "2025-01", table)
    assert tables.row_count(spark, table, JANUARY) == 50
    assert tables.row_count(spark, table, FEBRUARY) == 200


def test_pinned_columns(spark, deliver, table):
    load_month(spark, deliver("2025-01"), "2025-01", table, datetime(2025, 2, 3, 4, 5, 6))
    trips = tables.read_table(spark, table)
    assert dict(trips.dtypes) == {**RAW_COLUMNS, **AUDIT_COLUMNS}
    assert trips.columns == [*RAW_COLUMNS, "source_month", "loaded_at"]
    assert trips.select("source_month", "loaded_at").distinct().collect() == [(JANUARY, datetime(2025, 2, 3, 4, 5, 6))]


def test_load_time_is_one_moment(spark, deliver, table):
    load_month(spark, deliver("2025-01"), "2025-01", table)
    assert tables.read_table(spark, table).select("loaded_at").distinct().count() == 1


def test_missing_column_is_null(spark, deliver, table):
    path = deliver("2024-06", change=lambda df: df.drop("cbd_congestion_fee"))
    assert load_month(spark, path, "2024-06", table) == 300
    assert tables.read_table(spark, table).select(F.count("cbd_congestion_fee")).first()[0] == 0


def test_case_of_names_does_not_matter(spark, deliver, table):
    path = deliver("2025-01", change=lambda df: df.drop("Airport_fee").withColumn("airport_FEE", F.lit(1.5)))
    load_month(spark, path, "2025-01", table)
    assert tables.read_table(spark, table).select(F.min("Airport_fee"), F.max("Airport_fee")).first() == (1.5, 1.5)


def test_corrupt_file_keeps_old_rows(spark, deliver, table, tmp_path):
    load_month(spark, deliver("2025-01"), "2025-01", table)
    corrupt = tmp_path / "corrupt.parquet"
    corrupt.write_bytes(b"not a parquet file")
    with pytest.raises(Exception, match="(?i)parquet"):
        load_month(spark, str(corrupt), "2025-01", table)
    assert tables.row_count(spark, table, JANUARY) == 300


def test_failure_while_writing_keeps_old_rows(spark, deliver, table):
    load_month(spark, deliver("2025-01"), "2025-01", table)
    bad = deliver("2025-01", folder="bad", change=lambda df: df.withColumn("VendorID", F.lit("one")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_month(spark, bad, "2025-01", table)
    assert tables.row_count(spark, table, JANUARY) == 300


def test_bad_month(spark, deliver, table):
    with pytest.raises(ValueError, match="YYYY-MM"):
        load_month(spark, deliver("2025-01"), "January", table)


def test_types_may_drift_between_months(spark, deliver, table):
    whole = deliver("2025-01")
    fractional = deliver("2025-02", change=lambda df: df.withColumn("passenger_count", F.lit(2.5)))
    counts = load_months(spark, {"2025-01": whole, "2025-02": fractional, "2025-03": deliver("2025-03")}, table)
    assert counts == {"2025-01": 300, "2025-02": 300, "2025-03": 300}
    # 2.5 rounds half to even.
    february = tables.read_table(spark, table).where(F.col("source_month") == FEBRUARY)
    assert february.select("passenger_count").distinct().collect() == [(2,)]


def test_month_name_wins_over_file_name(spark, deliver, table):
    path = deliver("2025-01")
    load_months(spark, {"2025-01": path, "2025-02": path}, table)
    assert tables.stored_months(spark, table) == [JANUARY, FEBRUARY]
    assert tables.row_count(spark, table, FEBRUARY) == 300


def test_empty_delivery_empties_the_month(spark, deliver, table):
    load_months(spark, {"2025-01": deliver("2025-01"), "2025-02": deliver("2025-02")}, table)
    empty = deliver("2025-01", folder="empty", change=lambda df: df.where("false"))
    assert load_month(spark, empty, "2025-01", table) == 0
    assert tables.stored_months(spark, table) == [FEBRUARY]


def test_alignment_order_and_extra_columns(spark):
    df = spark.sql("SELECT 1 AS TOTAL_AMOUNT, 'x' AS surprise, 2.5D AS vendorid")
    aligned = align_to_schema(df)
    assert aligned.columns == list(RAW_COLUMNS)
    assert aligned.select("VendorID", "total_amount").first() == (2, 1.0)


def test_deliveries_are_one_scan_without_shuffle(spark, deliver, table):
    from meterline.sources.trips import read_deliveries

    rows = read_deliveries(spark, {m: deliver(m) for m in ("2025-01", "2025-02")})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == plan.count("BroadcastExchange")  # the list of files


def test_absent_columns_are_named_for_each_delivery(spark, deliver, table, caplog):
    whole, narrow = deliver("2025-01"), deliver("2025-02", change=lambda df: df.drop("cbd_congestion_fee", "extra"))
    load_months(spark, {"2025-01": whole, "2025-02": narrow}, table)
    said = [r.message for r in caplog.records if "lacks" in r.message]
    assert said == ["delivery of 2025-02 lacks extra, cbd_congestion_fee; filled with NULL"]


def test_a_delivery_without_files_is_an_error(spark, deliver, table, tmp_path):
    (tmp_path / "nothing").mkdir()
    with pytest.raises(Exception, match="no Parquet files delivered for 2025-02"):
        load_months(spark, {"2025-01": deliver("2025-01"), "2025-02": f"{tmp_path}/nothing"}, table)
    assert not tables.table_exists(spark, table)
