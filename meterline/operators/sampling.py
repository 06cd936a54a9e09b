"""Reproducible samples of a fixed size."""

from __future__ import annotations

import math
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources import files
from meterline.sources.tables import export_parquet


def _below(share: float) -> str:
    """Hex text that a uniformly drawn md5 is below with probability ``share``."""
    return format(min(int(share * 16**12), 16**12 - 1), "012x") if share < 1 else "g"


def sample_fixed(df: DataFrame, n: int, identity: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows (all, if there are fewer), drawn uniformly by a hash of the columns that identify a row.

    The draw does not depend on how the rows are partitioned. Rows with a high draw are cut before
    the sort. The cut is only used when enough rows are below it, hence never changes the result.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in identity)))
    drawn = df.withColumn("_draw", draw)
    total = df.count()
    share = (n + 6 * math.sqrt(n) + 10) / max(total, 1)
    while share < 1:
        cut = F.col("_draw") < _below(share)
        # Reads the identifying columns only.
        if drawn.where(cut).count() >= n:
            drawn = drawn.where(cut)
            break
        share *= 2
    return drawn.orderBy("_draw", *identity).limit(n).select(*df.columns)


def sample_files(spark: SparkSession, path: str, n: int, seed: int = 42) -> DataFrame:
    """Sample of Parquet rows, identified by file and position, so equal rows are drawn independently.

    A file is named by what its path has below ``path``, which is nothing where ``path`` is the file: tasks give their
    files the same name in every partition folder, and a copy of a folder gives the same sample.
    """
    rows = spark.read.parquet(path)
    plain = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9+.-]+):/+", "$1:/")
    root = re.sub("^([a-z0-9+.-]+):/+", r"\1:/", unquote(files.qualified(spark, path))).rstrip("/")
    file = F.substring(plain, len(root) + 1, 1 << 20)
    placed = rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return sample_fixed(placed, n, ["_file", "_row"], seed).select(*rows.columns)


def export_sample(spark: SparkSession, source: str, target: str, n: int = 3000, seed: int = 42) -> None:
    export_parquet(sample_files(spark, source, n, seed), target)
