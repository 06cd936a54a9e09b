"""File-arrival ingest.

The stream only discovers files: types may differ between months, which one fixed streaming
schema could not express. A discovered delivery is loaded as a whole by the month loader once it is complete: a file is
when it has its name, a folder when it holds a marker, or when none of its files is newer than a quiet time.

What is known of each delivery (its newest file seen, its newest file when it was loaded) is a small table beside the
stream's checkpoint. A delivery that is not complete yet waits there and is looked at again by the next call, with or
without new files. One that is loaded is loaded again only if files come that are newer. A batch repeated after
a failure finds its deliveries known and changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.sources import files, tables
from meterline.sources.trips import load_months

# Everything up to the path component that names the month.
_UNIT = r"^(.*yellow_tripdata_(\d{4}-(?:0[1-9]|1[0-2]))\.parquet[^/]*)(?:/.*)?$"
_KNOWN = "month string, unit string, newest double, loaded double"

# Fixed schema of Spark's file listing source; contents are never read.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def discover_files(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed Parquet files, one row per file, without opening any."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    return stream.load(landing).select("path", "modificationTime")


def deliveries(found: DataFrame) -> DataFrame:
    """Month, unit (path of a delivery) and newest change, in seconds, of the deliveries among the given files."""
    units = found.select(
        F.regexp_extract("path", _UNIT, 2).alias("month"),
        F.regexp_extract("path", _UNIT, 1).alias("unit"),
        (F.unix_micros("modificationTime") / 1e6).alias("newest"),
    )
    return units.where("month <> ''").groupBy("month", "unit").agg(F.max("newest").alias("newest"))


def _load_complete(
    spark: SparkSession,
    found: DataFrame | None,
    state: str,
    table: str,
    loaded_at: datetime | None,
    on_loaded: Callable[[dict[str, int]], None] | None,
    marker: str,
    quiet_seconds: float,
) -> None:
    """Remember the deliveries found and load those that are complete and not loaded as they are."""
    known = tables.read_table(spark, state) if tables.table_exists(spark, state) else spark.createDataFrame([], _KNOWN)
    if found is not None:
        known = known.unionByName(deliveries(found), allowMissingColumns=True)
    merged = known.groupBy("month", "unit").agg(F.max("newest").alias("newest"), F.max("loaded").alias("loaded"))
    # As many rows as deliveries.
    rows = [r.asDict() for r in merged.collect()]
    ready: dict[str, dict] = {}
    for row in sorted(rows, key=lambda r: (r["newest"], r["unit"])):
        if row["loaded"] is not None and row["newest"] <= row["loaded"]:
            continue
        is_file = not files.is_folder(spark, row["unit"])
        if is_file or files.exists(spark, f"{row['unit']}/{marker}") or time.time() - row["newest"] >= quiet_seconds:
            ready[row["month"]] = row  # the newest delivery of a month
    if ready:
        counts = load_months(spark, {month: row["unit"] for month, row in ready.items()}, table, loaded_at)
        done = {row["unit"]: row["newest"] for row in ready.values()}
        for row in rows:
            # Older deliveries of a month that was loaded are settled too.
            newer = ready.get(row["month"])
            if row["unit"] in done or newer and row["newest"] <= newer["newest"]:
                row["loaded"] = max(row["newest"], row["loaded"] or 0.0)
    tables.overwrite_table(spark.createDataFrame([tuple(r.values()) for r in rows], _KNOWN), state)
    if ready and on_loaded:
        on_loaded(counts)


def ingest_arrivals(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    *,
    loaded_at: datetime | None = None,
    on_loaded: Callable[[dict[str, int]], None] | None = None,
    max_files: int | None = None,
    marker: str = "_SUCCESS",
    quiet_seconds: float = 600,
) -> StreamingQuery:
    """Load every delivery that is complete and not loaded yet, then stop.

    A folder is complete when it holds a file named ``marker`` or has not changed for ``quiet_seconds``. All
    arrivals make one batch; ``max_files`` splits them.
    """
    state = f"{checkpoint.rstrip('/')}-deliveries"
    options = (state, table, loaded_at, on_loaded, marker, quiet_seconds)
    # What waited for the rest of its files; a stream without new files has no batch that could look.
    if tables.table_exists(spark, state):
        _load_complete(spark, None, *options)

    def load(batch: DataFrame, _batch_id: int) -> None:
        _load_complete(batch.sparkSession, batch, *options)

    return (
        discover_files(spark, landing, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
