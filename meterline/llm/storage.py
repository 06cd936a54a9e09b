"""Intermediate tables in the folder that all executors share, and this package's code on the executors."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import meterline
from meterline.session import scratch_path

_shipped: set[str] = set()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: computed once, and not again when executors are lost.

    The shuffle files of the write go when it ends, so disks hold those of one step at a time.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables of ``stored`` that nothing will read any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(meterline.__file__).parent
    if root.is_dir():  # else it was shipped to this process itself
        archive = Path(tempfile.mkdtemp()) / "meterline.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, f"{root.name}/{file.relative_to(root)}")
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _released() -> None:
    """Give memory that is free again back to the system: a Python worker outlives its task, and its stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function, leaving no free memory behind when its batches end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            _released()

    return run


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(releasing(function), schema)
