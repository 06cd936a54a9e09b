"""Time the headline steps and queries on the feed derived from the test tables; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.feed import CONFIG, RULES, delivery_path, feed, land, zones
from meterline.operators import checks, marts
from meterline.operators.dims import dim_zones
from meterline.operators.enrich import enrich_trips
from meterline.operators.fact import build_fact, fact_rows
from meterline.operators.sampling import sample_files
from meterline.operators.staging import drop_counts, stage_trips, stage_zones
from meterline.plans import runs
from meterline.session import build_session, scratch_path
from meterline.sources import tables
from meterline.sources.months import month_name
from meterline.sources.schemas import RAW_COLUMNS
from meterline.sources.trips import load_months

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
AT = datetime(2025, 1, 1)


def one_month(trips: DataFrame, times: int = 5) -> DataFrame:
    """All trips moved to January 2025, each several times with a fare of its own."""
    moved = "make_timestamp_ntz(2025, 1, LEAST(DAY({0}), 28), HOUR({0}), MINUTE({0}), SECOND({0}))"
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return trips.select("*", F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("n")).selectExpr(
        *(
            {
                start: f"{moved.format(start)} AS {start}",
                end: f"{moved.format(start)} + ({end} - {start}) AS {end}",
                "fare_amount": "fare_amount + n / 100D AS fare_amount",
            }.get(c, c)
            for c in RAW_COLUMNS
        )
    )


def main() -> None:
    conf = {"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"}
    spark = build_session("bench", f"local[{CPUS}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action: Callable[[], object], warm: bool = True) -> None:
        """Second of two runs where ``warm``: the first lets Java compile code no earlier step has run."""
        if warm:
            action()
        started = time.monotonic()
        action()
        seconds[name] = round(time.monotonic() - started, 3)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    landing = land(feed(spark, SF_DIR), scratch_path(spark, "landing"))
    starts = sorted(r[0] for r in feed(spark, SF_DIR).select("source_month").distinct().collect())
    deliveries = {month_name(s): delivery_path(landing, month_name(s)) for s in starts}
    lookup = zones(spark, SF_DIR)
    staged_zones = stage_zones(lookup)
    house = runs.Warehouse(scratch_path(spark, "bench"))

    timed("load_months", lambda: load_months(spark, deliveries, house.raw, AT))
    raw = tables.read_table(spark, house.raw).cache()
    rows = raw.count()
    raw.unpersist()

    def staged():
        return stage_trips(tables.read_table(spark, house.raw), RULES)

    timed("stage", lambda: consume(staged()))
    timed("drop_counts", lambda: drop_counts(tables.read_table(spark, house.raw), RULES).collect())
    timed("enrich", lambda: consume(enrich_trips(staged(), staged_zones)))
    timed("dedup", lambda: consume(fact_rows(staged())))

    def build(months: list[date] | None = None) -> None:
        build_fact(spark, house.raw, house.fact, months=months, rules=RULES)

    timed("fact_first_build", build, warm=False)
    timed("fact_upsert_all_months", lambda: build(starts), warm=False)
    timed("fact_upsert_one_month", lambda: build(starts[40:41]))

    def fact():
        return tables.read_table(spark, house.fact)

    states = house.opened(spark)

    def stage(name: str, action: Callable[[], tables.State]) -> None:
        states[name] = action()

    timed("mart_cells", lambda: stage("cells", lambda: runs.stage_cells(spark, house, states, starts)), warm=False)
    timed("marts", lambda: states.update(runs.stage_marts(spark, house, states, staged_zones)))
    timed("daily_from_fact", lambda: consume(marts.mart_daily_revenue(marts.trip_cells(fact(), ["pickup_date"]))))
    timed(
        "hourly_from_fact",
        lambda: consume(marts.mart_hourly_demand(marts.trip_cells(fact(), ["pickup_hour", "pickup_date"]))),
    )
    timed(
        "zones_from_fact",
        lambda: consume(
            marts.mart_zone_performance(marts.trip_cells(fact(), ["pickup_location_id"]), dim_zones(staged_zones))
        ),
    )
    timed("unique_trip_id", lambda: checks.duplicate_keys(fact(), "trip_id").count())

    def data_tests() -> None:
        states.pop("findings", None)
        states["findings"] = runs.stage_findings(spark, house, states, CONFIG)
        runs.run_tests(spark, states, staged_zones, CONFIG)

    timed("data_tests", data_tests, warm=False)
    timed(
        "delivery_checks",
        lambda: checks.check_deliveries(tables.read_table(spark, house.raw), fact(), starts, CONFIG.limits),
    )
    timed("sample", lambda: consume(sample_files(spark, f"{SF_DIR}/lineitem.parquet", 3000)))
    # All trips five times over in one month: the size the published load times are about.
    big = runs.Warehouse(scratch_path(spark, "big"))
    delivery = f"{big.root}/landing/yellow_tripdata_2025-01.parquet"
    one_month(feed(spark, SF_DIR)).repartition(int(CPUS)).write.parquet(delivery)
    big_rows = spark.read.parquet(delivery).count()
    timed("big_month_load", lambda: load_months(spark, {"2025-01": delivery}, big.raw, AT), warm=False)
    january = [date(2025, 1, 1)]
    timed(
        "big_month_fact",
        lambda: build_fact(spark, big.raw, scratch_path(spark, "fact"), months=january, rules=RULES),
    )
    timed(
        "big_month_run",
        lambda: runs.run_months(
            spark, ["2025-01"], "", big, lookup, CONFIG, paths={"2025-01": delivery}, at=AT
        ),
        warm=False,
    )
    whole = runs.Warehouse(scratch_path(spark, "whole"))
    timed(
        "whole_run",
        lambda: runs.run_months(spark, list(deliveries), "", whole, lookup, CONFIG, paths=deliveries, at=AT),
        warm=False,
    )
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "raw_rows": rows,
                "months": len(starts),
                "load_rows_per_sec": round(rows / seconds["load_months"]),
                "whole_run_rows_per_sec": round(rows / seconds["whole_run"]),
                "big_month_rows": big_rows,
                "big_month_load_rows_per_sec": round(big_rows / seconds["big_month_load"]),
                "big_month_run_rows_per_sec": round(big_rows / seconds["big_month_run"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
