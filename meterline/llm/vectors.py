"""Vectors of whole numbers, for the operators that must score exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components from here on are an error: sums of their squares and products would leave 64 bits.
LARGEST = 1 << 27


def whole_numbers(vectors: DataFrame, scale: int, **columns: Column) -> DataFrame:
    """``columns``, then ``v``: floor(scale * x) of each component x of ``embedding``.

    Rows whose vector is null, empty or of another length than most (of equally many: than the longest), or holds a
    null or non-finite component, are left out. A component of ``LARGEST`` or more raises an error.
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(*(c.alias(name) for name, c in columns.items()), x.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where((F.size("v") > 0) & finite)
    lengths = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1)
    found = lengths.collect()
    if found:
        rows = rows.where(F.size("v") == found[0]["length"])
    too_large = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("long")
    floor = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(too_large)
    return rows.withColumn("v", F.transform("v", floor))


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.int64) -> np.ndarray:
    """A list column whose rows are equally long, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)
