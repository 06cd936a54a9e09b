import random
from datetime import datetime

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterline.functions import expressions as X


def test_money_and_number_text_match_the_reference_engine(spark):
    draw = random.Random(7)
    values = [draw.choice([-1, 1]) * round(draw.uniform(0, 1200), draw.choice([1, 2, 3, 4])) for _ in range(5000)]
    values += [0.125, 1.005, -1.005, 2.675, 0.0, -0.0, 1000.004, -0.004, -0.005, 0.0009, 0.00012, 1e7, 12345678.5, 7.1e7]
    frame = pd.DataFrame({"x": values})
    con = duckdb.connect()
    con.register("frame", frame)
    want = con.sql("SELECT x, x::DECIMAL(10,2) AS m, x::VARCHAR AS t FROM frame").fetchall()
    got = spark.createDataFrame(frame).select("x", X.money(F.col("x")), X.number_text(F.col("x"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_rounding_bounds_agree_with_money(spark):
    values = [(v,) for v in (-0.01, -0.005, -0.0049, 0.0, 999.995, 1000.0, 1000.004, 1000.00499, 1000.005, 1000.01)]
    x = F.col("x")
    rows = spark.createDataFrame(values, "x double").select(
        (X.money(x) < 0) == X.rounds_below_zero(x), (X.money(x) > 1000) == X.rounds_above(x, 1000)
    )
    assert set(map(tuple, rows.collect())) == {(True, True)}


def test_safe_divide(spark):
    row = spark.range(1).select(
        X.safe_divide(F.lit(1), F.lit(0)), X.safe_divide(F.lit(1), F.lit(None)), X.safe_divide(F.lit(1), F.lit(4))
    )
    assert row.first() == (None, None, 0.25)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_expressions_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # In New York the second of these nights skips an hour.
        rows = [
            (datetime(2025, 1, 1, 0, 0, 0, 900000), datetime(2025, 1, 1, 0, 0, 1, 100000)),
            (datetime(2025, 3, 8, 23, 0), datetime(2025, 3, 9, 4, 0)),
            (datetime(2024, 12, 31, 23, 59, 59), datetime(2025, 1, 1, 0, 0)),
        ]
        df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
        got = df.select(
            X.seconds_between(F.col("a"), F.col("b")), X.month_of(F.col("b")).cast("string"), X.iso_weekday(F.col("b"))
        )
        assert [tuple(r) for r in got.collect()] == [(1, "2025-01-01", 3), (18000, "2025-03-01", 7), (1, "2025-01-01", 3)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("miles", "seconds", "speed"),
    [(1.0, 59, None), (1.0, 60, 60.0), (0.0, 600, None), (100.0, 3600, 100.0), (100.1, 3600, None), (None, 600, None)],
)
def test_speed(spark, miles, seconds, speed):
    row = spark.createDataFrame([(miles, seconds / 60)], "miles double, minutes double")
    assert row.select(X.avg_speed_mph(F.col("miles"), F.col("minutes"))).first()[0] == speed


def test_tip_only_for_card_trips_with_a_fare(spark):
    rows = [(1, "0.07", "10"), (2, "5", "10"), (1, "5", "0"), (None, "5", "10")]
    df = spark.createDataFrame(rows, "p int, t string, f string")
    tip, fare = (F.col(c).cast("decimal(10,2)") for c in "tf")
    assert [r[0] for r in df.select(X.tip_pct(F.col("p"), tip, fare)).collect()] == [0.7, None, None, None]


def test_payment_names(spark):
    codes = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 5, 6, 7, None)], "c int")
    names = [r[0] for r in codes.select(X.payment_type_name(F.col("c"))).collect()]
    assert names == [*X.PAYMENT_TYPES.values(), "Other", "Other"]


def test_key_skips_missing_parts(spark):
    import hashlib

    from tests.conftest import trip
    from meterline.sources.schemas import RAW_SCHEMA

    df = spark.createDataFrame([tuple(trip(VendorID=None).values())], RAW_SCHEMA)
    text = "2025-01-15 08:00:00|2025-01-15 08:30:00|1|2|5.0|20.0|26.5"
    assert df.select(X.trip_key()).first()[0] == hashlib.md5(text.encode()).hexdigest()
