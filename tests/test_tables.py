from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterline.operators.fact import build_fact
from meterline.sources import files, tables
from meterline.sources.trips import load_months
from tests.conftest import trip

JANUARY, FEBRUARY, MARCH = date(2025, 1, 1), date(2025, 2, 1), date(2025, 3, 1)


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/t"


@pytest.fixture
def rows(spark):
    def build(*values, columns="k string, v int, source_month date"):
        return spark.createDataFrame(list(values), columns)

    return build


def content(spark, path):
    return sorted(map(tuple, tables.read_table(spark, path).collect()), key=str)


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, rows, path):
    tables.upsert_by_key(rows(("a", 1, JANUARY), ("b", 1, JANUARY), ("c", 1, FEBRUARY)), path, "k", [JANUARY, FEBRUARY])
    batch = rows(("b", 2, JANUARY), ("d", 2, JANUARY), ("e", 2, MARCH))
    for _ in range(2):
        tables.upsert_by_key(batch, path, "k", [JANUARY, MARCH])
    assert content(spark, path) == [
        ("a", 1, JANUARY),
        ("b", 2, JANUARY),
        ("c", 1, FEBRUARY),
        ("d", 2, JANUARY),
        ("e", 2, MARCH),
    ]


def test_upsert_inserts_every_row_of_the_batch(spark, rows, path):
    tables.upsert_by_key(rows(("a", 1, JANUARY)), path, "k", [JANUARY])
    tables.upsert_by_key(rows(("a", 2, JANUARY), ("a", 3, JANUARY)), path, "k", [JANUARY])
    assert content(spark, path) == [("a", 2, JANUARY), ("a", 3, JANUARY)]


def test_empty_batch_changes_nothing(spark, rows, path):
    tables.upsert_by_key(rows(("a", 1, JANUARY)), path, "k", [JANUARY])
    tables.upsert_by_key(rows(("a", 1, JANUARY)).where("false"), path, "k", [JANUARY])
    assert content(spark, path) == [("a", 1, JANUARY)]


def test_new_columns_are_appended_and_lost_ones_stay(spark, rows, path):
    tables.upsert_by_key(rows(("a", 1, JANUARY), ("b", 1, FEBRUARY)), path, "k", [JANUARY, FEBRUARY])
    wider = rows(("c", "x", MARCH), columns="k string, note string, source_month date")
    tables.upsert_by_key(wider, path, "k", [MARCH])
    assert tables.read_table(spark, path).columns == ["k", "v", "source_month", "note"]
    assert content(spark, path) == [
        ("a", 1, JANUARY, None),
        ("b", 1, FEBRUARY, None),
        ("c", None, MARCH, "x"),
    ]
    tables.upsert_by_key(rows(("a", 5, JANUARY)), path, "k", [JANUARY])
    assert ("c", None, MARCH, "x") in content(spark, path) and ("a", 5, JANUARY, None) in content(spark, path)


def test_replace_drops_months_without_rows(spark, rows, path):
    tables.write_months(rows(("a", 1, JANUARY), ("b", 1, FEBRUARY), ("c", 1, MARCH)), path, [JANUARY, FEBRUARY, MARCH])
    tables.write_months(rows(("d", 1, FEBRUARY)), path, [JANUARY, FEBRUARY])
    assert tables.stored_months(spark, path) == [FEBRUARY, MARCH]
    assert content(spark, path) == [("c", 1, MARCH), ("d", 1, FEBRUARY)]


def test_upsert_scans_only_the_months_it_touches(spark, rows, path):
    tables.upsert_by_key(rows(("a", 1, JANUARY), ("b", 1, FEBRUARY)), path, "k", [JANUARY, FEBRUARY])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    old = tables.read_table(spark, path).where(tables.in_months([JANUARY]))
    assert "PartitionFilters: [isnotnull(source_month" in old._jdf.queryExecution().executedPlan().toString()
    assert len(old.inputFiles()) == len(tables.read_table(spark, path).inputFiles())
    assert old.count() == 1


def test_a_table_can_be_rebuilt_from_itself(spark, path):
    tables.overwrite_table(spark.range(5), path)
    tables.overwrite_table(tables.read_table(spark, path).select((F.col("id") * 2).alias("id")), path)
    assert content(spark, path) == [(0,), (2,), (4,), (6,), (8,)]


def test_failed_rebuild_keeps_the_old_table(spark, path):
    tables.overwrite_table(spark.range(5), path)
    with pytest.raises(Exception, match="(?i)boom"):
        tables.overwrite_table(spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")), path)
    assert tables.read_table(spark, path).count() == 5


def test_export_is_zstd(spark, path):
    tables.export_parquet(spark.range(5), path)
    assert all(".zstd." in f for f in files.file_names(spark, path) if f.endswith(".parquet"))


def test_missing_table(spark, path):
    assert not tables.table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)


# Incremental builds of the fact.


@pytest.fixture
def raw(spark, raw_of, tmp_path):
    """Raw table with one trip on each of the given days; later calls replace their months."""
    path = f"{tmp_path}/raw"

    def write(*days: str, passengers: int = 1) -> str:
        trips = []
        for day in days:
            start = datetime.fromisoformat(f"{day} 08:00")
            trips.append(
                trip(
                    tpep_pickup_datetime=start,
                    tpep_dropoff_datetime=start.replace(hour=9),
                    passenger_count=passengers,
                    source_month=start.date().replace(day=1),
                )
            )
        tables.write_months(raw_of(*trips), path, {t["source_month"] for t in trips})
        return path

    return write


def passengers_by_day(spark, path):
    return {str(r.pickup_date): r.passenger_count for r in tables.read_table(spark, path).collect()}


def test_first_build_ignores_the_window(spark, raw, path):
    raw_path = raw("2025-01-05", "2025-02-05", "2025-03-05")
    assert build_fact(spark, raw_path, path, (FEBRUARY, MARCH)) == [JANUARY, FEBRUARY, MARCH]
    assert len(passengers_by_day(spark, path)) == 3


def test_window_is_half_open(spark, raw, path):
    build_fact(spark, raw("2025-01-05", "2025-02-05", "2025-03-01"), path)
    raw_path = raw("2025-01-05", "2025-02-05", "2025-03-01", passengers=2)
    assert build_fact(spark, raw_path, path, (date(2025, 1, 6), MARCH)) == [JANUARY, FEBRUARY]
    assert passengers_by_day(spark, path) == {"2025-01-05": 1, "2025-02-05": 2, "2025-03-01": 1}


def test_lookback_reaches_back_three_days(spark, raw, path):
    build_fact(spark, raw("2025-01-27", "2025-01-28", "2025-01-31"), path)
    raw_path = raw("2025-01-27", "2025-01-28", "2025-01-31", "2025-02-20", passengers=2)
    build_fact(spark, raw_path, path)
    assert passengers_by_day(spark, path) == {"2025-01-27": 1, "2025-01-28": 2, "2025-01-31": 2, "2025-02-20": 2}


def test_upsert_keeps_fact_rows_that_left_the_feed_and_replace_does_not(spark, raw, path):
    build_fact(spark, raw("2025-01-05", "2025-01-06"), path)
    raw_path = raw("2025-01-06")
    build_fact(spark, raw_path, path, months=[JANUARY])
    assert passengers_by_day(spark, path).keys() == {"2025-01-05", "2025-01-06"}
    build_fact(spark, raw_path, path, months=[JANUARY], mode="replace")
    assert passengers_by_day(spark, path).keys() == {"2025-01-06"}


def test_loading_and_building_in_any_order_agree(spark, deliver, tmp_path):
    deliveries = {m: deliver(m, 60) for m in ("2025-01", "2025-02", "2025-03")}
    results = []
    for name, order in (("a", ["2025-01", "2025-02", "2025-03"]), ("b", ["2025-03", "2025-01", "2025-02", "2025-01"])):
        raw_path, fact_path = f"{tmp_path}/{name}/raw", f"{tmp_path}/{name}/fact"
        for month in order:
            load_months(spark, {month: deliveries[month]}, raw_path, datetime(2025, 4, 1))
            build_fact(spark, raw_path, fact_path, months=[date.fromisoformat(f"{month}-01")])
        results.append(content(spark, fact_path))
    assert results[0] == results[1] and len(results[0]) == 180
