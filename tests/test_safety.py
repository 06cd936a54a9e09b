"""Loads that must not lose rows, columns or accuracy."""

import contextlib
import os
import shutil
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterline.functions import expressions as X
from meterline.operators.sampling import sample_files
from meterline.operators.staging import stage_trips
from meterline.sources import files, tables
from meterline.sources.trips import load_months, read_month
from tests.conftest import trip

AT = datetime(2025, 5, 1)


def delivered(raw_of, path, month, n, *drop, **changes):
    at = datetime(2025, month, 3, 8)
    rows = [trip(VendorID=i, tpep_pickup_datetime=at, tpep_dropoff_datetime=at, **changes) for i in range(n)]
    raw_of(*rows).drop("source_month", "loaded_at", *drop).coalesce(1).write.mode("append").parquet(path)


def test_a_folder_with_files_of_two_layouts_loses_no_column(spark, raw_of, tmp_path):
    folder, table = f"{tmp_path}/yellow_tripdata_2025-03.parquet", f"{tmp_path}/raw"
    delivered(raw_of, folder, 3, 10, "cbd_congestion_fee")
    delivered(raw_of, folder, 3, 10)
    assert load_months(spark, {"2025-03": folder}, table, AT) == {"2025-03": 20}
    assert tables.read_table(spark, table).where("cbd_congestion_fee = 0.75").count() == 10


def test_a_folder_with_types_that_differ(spark, raw_of, tmp_path):
    folder, table = f"{tmp_path}/yellow_tripdata_2025-03.parquet", f"{tmp_path}/raw"
    delivered(raw_of, folder, 3, 5)
    counts = raw_of(trip()).drop("source_month", "loaded_at").withColumn("passenger_count", F.lit(2.0))
    counts.write.mode("append").parquet(folder)
    assert load_months(spark, {"2025-03": folder}, table, AT) == {"2025-03": 6}
    assert tables.read_table(spark, table).agg(F.sum("passenger_count")).first()[0] == 7


def test_months_come_from_the_delivery_not_from_inner_names(spark, raw_of, tmp_path):
    table, paths = f"{tmp_path}/raw", {}
    delivered(raw_of, f"{tmp_path}/first", 1, 3)
    load_months(spark, {"2025-01": f"{tmp_path}/first"}, table, AT)
    for month in (3, 4):
        folder = f"{tmp_path}/yellow_tripdata_2025-0{month}.parquet"
        delivered(raw_of, f"{folder}/yellow_tripdata_2025-01.parquet", month, month)
        paths[f"2025-0{month}"] = f"{folder}/yellow_tripdata_2025-01.parquet"
    assert load_months(spark, paths, table, AT) == {"2025-03": 3, "2025-04": 4}
    assert tables.row_count(spark, table, date(2025, 1, 1)) == 3


def test_a_stray_row_stops_the_write_and_keeps_the_old_rows(spark, tmp_path):
    table = f"{tmp_path}/t"
    january, february = date(2025, 1, 1), date(2025, 2, 1)
    rows = spark.createDataFrame([("f1", february), ("f2", february)], "k string, source_month date")
    tables.write_months(rows, table, [february])
    batch = spark.createDataFrame([("j1", january), ("stray", february)], "k string, source_month date")
    with pytest.raises(Exception, match="outside the listed months"):
        tables.upsert_by_key(batch, table, "k", [january])
    assert sorted(r.k for r in tables.read_table(spark, table).collect()) == ["f1", "f2"]


def test_appended_columns_survive_another_write(spark, tmp_path):
    table = f"{tmp_path}/t"
    months = [date(2025, 1, 1), date(2025, 2, 1)]
    tables.write_months(
        spark.createDataFrame([("a", "new", months[0])], "k string, extra string, source_month date"), table, months[:1]
    )
    tables.write_months(spark.createDataFrame([("b", months[1])], "k string, source_month date"), table, months[1:])
    assert sorted((r.k, r.extra) for r in tables.read_table(spark, table).collect()) == [("a", "new"), ("b", None)]


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf"), 1e17, 1e300, -1e300])
@pytest.mark.parametrize("column", ["fare_amount", "total_amount", "tip_amount", "trip_distance", "tolls_amount"])
def test_dirty_numbers_neither_stop_staging_nor_touch_good_rows(raw_of, column, value):
    staged = stage_trips(raw_of(trip(VendorID=1), trip(VendorID=2, **{column: value}))).collect()
    good = [r for r in staged if r.vendor_id == 1]
    assert len(good) == 1 and good[0].fare_amount == 20
    assert len(staged) == 1


def test_number_text_on_both_sides_of_its_range(spark):
    values = [1e17, 1e300, 9999999999999998.0, 1e7, 0.0001, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(X.number_text(F.col("v"))).collect()]
    assert got == ["1.0E17", "1.0E300", "9999999999999998.0", "10000000.0", "0.0001", "0.0"]


def test_rows_of_different_folders_are_drawn_apart(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(4000).select("id", (F.col("id") % 4).alias("part")).repartition(1)
    rows.write.partitionBy("part").parquet(path)
    drawn = sample_files(spark, path, 400).collect()
    positions = {r.id // 4 for r in drawn}
    assert len(drawn) == 400 and len(positions) > 300  # 100 if folders shared their draws


class Lost(Exception):
    """The driver, at some step."""


@contextlib.contextmanager
def lost_at(monkeypatch, step):
    """The driver dies instead of its n-th change of a file or folder."""
    left = [step]

    def dying(change):
        def call(*args):
            left[0] -= 1
            if left[0] == 0:
                raise Lost
            return change(*args)

        return call

    with monkeypatch.context() as patched:
        for name in ("rename", "write_text", "delete"):
            patched.setattr(files, name, dying(getattr(files, name)))
        yield


def tried(action):
    try:
        action()
    except Lost:
        return False
    return True


def test_a_driver_lost_at_any_step_of_a_write_leaves_the_old_or_the_new_rows(spark, tmp_path, monkeypatch):
    months = [date(2025, 1, 1), date(2025, 2, 1)]
    seen = set()
    for step in range(1, 30):
        table = f"{tmp_path}/t{step}"
        for n in range(tables.KEEP + 1):  # so that versions are cleared too
            tables.write_months(spark.createDataFrame([(n, m) for m in months], "v int, source_month date"), table, months)
        with lost_at(monkeypatch, step):
            batch = spark.createDataFrame([(100, m) for m in months], "v int, source_month date")
            done = tried(lambda: tables.upsert_by_key(batch, table, "v", months))
        values = {r.v for r in tables.read_table(spark, table).where("v >= 3").collect()}
        assert values in ({3}, {3, 100})
        assert values == {3, 100} or not done
        assert {r.source_month for r in tables.read_table(spark, table).where("v = 100").collect()} in (set(), set(months))
        seen.add(100 in values)
        tables.write_months(spark.createDataFrame([(7, m) for m in months], "v int, source_month date"), table, months)
        assert {r.v for r in tables.read_table(spark, table).collect()} == {7}
        if done:
            break
    assert done and seen == {True, False}


def test_a_read_ends_on_the_rows_it_started_with(spark, tmp_path):
    table = f"{tmp_path}/t"
    tables.overwrite_table(spark.range(3), table)
    started = tables.read_table(spark, table)
    first = tables.versions(spark, table)[-1]
    tables.overwrite_table(spark.range(5), table)
    assert started.count() == 3 and tables.read_table(spark, table).count() == 5
    assert tables.read_table(spark, table, first).count() == 3
    for n in range(tables.KEEP + 2):
        tables.overwrite_table(spark.range(n), table)
    assert len(tables.versions(spark, table)) == tables.KEEP
    assert len([f for f in files.child_folders(spark, table) if f.startswith("write=")]) <= tables.KEEP + 1


def test_two_writers_cannot_commit_one_version(spark, tmp_path):
    table = f"{tmp_path}/t"
    tables.overwrite_table(spark.range(3), table)
    one, two = tables.stage_rebuild(spark.range(4), table), tables.stage_rebuild(spark.range(5), table)
    tables.commit(spark, one, 2)
    with pytest.raises(tables.Conflict, match="version 2"):
        tables.commit(spark, two, 2)
    assert tables.read_table(spark, table).count() == 4


def test_abandoned_folders_go_and_fresh_ones_stay(spark, tmp_path):
    table = f"{tmp_path}/t"
    tables.overwrite_table(spark.range(3), table)
    left = [tables.stage_rebuild(spark.range(n), table).parts[0].folder for n in (1, 2)]
    old = time.time() - (tables.ABANDONED_DAYS + 1) * 86400
    os.utime(f"{table}/{left[0]}", (old, old))
    tables.overwrite_table(spark.range(4), table)
    assert left[0] not in files.child_folders(spark, table) and left[1] in files.child_folders(spark, table)


def test_an_upsert_computes_its_batch_once(spark, tmp_path):
    table, january = f"{tmp_path}/t", date(2025, 1, 1)
    tables.write_months(spark.createDataFrame([("a", 1, january), ("b", 1, january)], "k string, v int, source_month date"), table, [january])
    computed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    batch = spark.createDataFrame([("b", 2, january), ("c", 2, january)], "k string, v int, source_month date")
    tables.upsert_by_key(batch.mapInPandas(counting, batch.schema), table, "k", [january])
    assert computed.value == 2
    assert sorted((r.k, r.v) for r in tables.read_table(spark, table).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_many_files_of_two_layouts_take_a_bounded_number_of_jobs(spark, raw_of, tmp_path):
    folder = f"{tmp_path}/yellow_tripdata_2025-03.parquet"
    delivered(raw_of, f"{tmp_path}/one", 3, 2)
    counts = raw_of(trip(), trip()).drop("source_month", "loaded_at").withColumn("passenger_count", F.lit(2.0))
    counts.coalesce(1).write.parquet(f"{tmp_path}/two")
    os.mkdir(folder)
    for name in ("one", "two"):
        file = next(f for f in os.listdir(f"{tmp_path}/{name}") if f.startswith("part"))
        for i in range(30):
            shutil.copy(f"{tmp_path}/{name}/{file}", f"{folder}/{i}-{name}.parquet")
    spark.sparkContext.setJobGroup("layouts", "layouts")
    rows = read_month(spark, folder, "2025-03", AT)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("layouts"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 10
    assert rows.count() == 120 and rows.agg(F.sum("passenger_count")).first()[0] == 60 * 1 + 60 * 2
