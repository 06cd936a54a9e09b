"""Month loader: align a delivered file to the pinned layout and replace that month."""

from __future__ import annotations

import logging
import re
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import side_by_side
from meterline.sources import files, tables
from meterline.sources.months import month_start
from meterline.sources.schemas import RAW_COLUMNS

log = logging.getLogger(__name__)

_FRACTIONAL = ("double", "float", "decimal")


def _typed(name: str, have: str | None, kind: str | None, wanted: str) -> str:
    """SQL of one column of the layout, from the file's column of that name if it has one."""
    if have is None:
        return f"CAST(NULL AS {wanted}) AS `{name}`"
    # A cast to a whole number truncates; the feed's former DOUBLE counts round half to even.
    rounds = wanted == "bigint" and kind.startswith(_FRACTIONAL)
    value = f"rint(`{have}`)" if rounds else f"`{have}`"
    return f"CAST({value} AS {wanted}) AS `{name}`"


def align_to_schema(df: DataFrame, columns: dict[str, str] = RAW_COLUMNS, *extra: str) -> DataFrame:
    """The layout's columns with its types: names match in any case, absent ones are NULL, others go.

    ``extra`` are further SQL expressions to append.
    """
    have = {field.lower(): (field, kind) for field, kind in df.dtypes}
    absent = [name for name in columns if name.lower() not in have]
    if absent:
        log.warning("delivery lacks %s; filled with NULL", ", ".join(absent))
    typed = (_typed(name, *have.get(name.lower(), (None, None)), wanted) for name, wanted in columns.items())
    return df.selectExpr(*typed, *extra)


def _audited(df: DataFrame, source_month: str, loaded_at: datetime | None) -> DataFrame:
    loaded = f"TIMESTAMP_NTZ '{loaded_at}'" if loaded_at else "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    return align_to_schema(df, RAW_COLUMNS, f"{source_month} AS source_month", f"{loaded} AS loaded_at")


def _layout(spark: SparkSession, file: str) -> str:
    """The layout in a file's footer, in Parquet's own words; no Spark job."""
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)), spark._jsc.hadoopConfiguration()
    )
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString()
    finally:
        reader.close()


def _plain(path: str) -> str:
    """A path as Spark names files: one slash behind the file system, nothing encoded."""
    return re.sub("^([a-z0-9+.-]+):/+", r"\1:/", unquote(path))


def _scans(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """All files below the paths, in one scan for each set of layouts that go together.

    Layouts that agree in the types of their common columns are merged by one job, whatever the number of
    files. Where types differ, files are grouped by the layout in their footers: one scan for each layout.
    """
    whole = spark.read.option("mergeSchema", "true")
    try:
        return [whole.parquet(*paths)]
    except Exception as error:  # Spark's, of several classes; the message tells
        if "CANNOT_MERGE" not in str(error):
            raise
    named = [spark.read.schema("`a` int").parquet(path).inputFiles() for path in paths]
    files_ = sorted({f for found in named for f in found})
    layouts: dict[str, list[str]] = {}
    for file, layout in zip(files_, side_by_side([lambda f=f: _layout(spark, f) for f in files_], 32), strict=True):
        layouts.setdefault(layout, []).append(file)
    return [spark.read.schema(spark.read.parquet(v[0]).schema).parquet(*v) for v in layouts.values()]


def _warn_of_absent(spark: SparkSession, first: dict[str, str]) -> None:
    """Name the columns of the pinned layout that a delivery (month -> its first file) does not have."""
    layouts = side_by_side([lambda f=f: _layout(spark, f) for f in first.values()], 32)
    for month, layout in zip(first, layouts, strict=True):
        have = {name.lower() for name in re.findall(r"^  \w+ \S+ ([^\s;]+)", layout, re.MULTILINE)}
        absent = [c for c in RAW_COLUMNS if c.lower() not in have]
        if absent:
            log.warning("delivery of %s lacks %s; filled with NULL", month, ", ".join(absent))


def _roots(paths: set[str]) -> list[str]:
    """The paths that do not lie below another one, so that no file is read twice."""
    return sorted(p for p in paths if not any(p != q and p.startswith(q.rstrip("/") + "/") for q in paths))


def _months_of_files(files_: list[str], deliveries: dict[str, str]) -> list[tuple[str, str]]:
    """(file, month) for each delivery that a file belongs to, by the folders above it."""
    months: dict[str, list[str]] = {}
    for month, path in deliveries.items():
        months.setdefault(_plain(path).rstrip("/"), []).append(month)
    out = []
    for file in files_:
        above = _plain(file)
        while above:
            out += [(file, month) for month in months.get(above, [])]
            above = above.rpartition("/")[0]
    return out


def read_deliveries(spark: SparkSession, deliveries: dict[str, str], loaded_at: datetime | None = None) -> DataFrame:
    """Rows of several delivered months (month -> path); the month is the delivery's, whatever its files are called.

    One scan reads all deliveries of a layout. A row's month is looked up by the file it stands in.
    """
    places = {month: files.qualified(spark, path) for month, path in deliveries.items()}
    parts, first = [], {}
    for scan in _scans(spark, _roots(set(places.values()))):
        found = _months_of_files(sorted(scan.inputFiles()), places)
        for file, month in found:
            first.setdefault(month, file)
        # The driver has listed these files to plan the scan, one short row each.
        lookup = spark.createDataFrame([(f, month_start(m)) for f, m in found], "_file string, _month date")
        rows = scan.withColumn("_file", F.input_file_name()).join(F.broadcast(lookup), "_file")
        parts.append(_audited(rows, "_month", loaded_at))
    without = deliveries.keys() - first.keys()
    if without:
        raise FileNotFoundError(f"no Parquet files delivered for {', '.join(sorted(without))}")
    _warn_of_absent(spark, first)
    return reduce(DataFrame.union, parts)


def read_month(spark: SparkSession, path: str, month: str, loaded_at: datetime | None = None) -> DataFrame:
    """Rows of one delivered month in raw layout, audit columns included."""
    return read_deliveries(spark, {month: path}, loaded_at)


def stage_load(
    spark: SparkSession, deliveries: dict[str, str], path: str, base: tables.State | None, loaded_at: datetime | None = None
) -> tuple[tables.State, dict[str, int]]:
    """The raw table with each delivered month (month -> path) replaced, not committed yet, and its rows per month."""
    starts = {month: month_start(month) for month in deliveries}
    rows = read_deliveries(spark, deliveries, loaded_at)
    # A task reads whole files or pieces of one, so rows of a month need no gathering.
    staged = tables.counted(spark, tables.stage_months(rows, path, starts.values(), base, gather=False))
    loaded = {month: tables.month_rows(staged, start) for month, start in starts.items()}
    for month, start in starts.items():
        log.info("month %s loaded: %s rows, formerly %s", month, loaded[month], tables.month_rows(base, start))
    return staged, loaded


def load_months(
    spark: SparkSession, deliveries: dict[str, str], table: str, loaded_at: datetime | None = None
) -> dict[str, int]:
    """Replace each delivered month (month -> path) in the raw table, all at once; rows loaded per month.

    Repeating a load gives the same table.
    """
    base = tables.current(spark, table)
    staged, loaded = stage_load(spark, deliveries, table, base and tables.counted(spark, base), loaded_at)
    tables.commit(spark, staged)
    return loaded


def load_month(
    spark: SparkSession, path: str, month: str, table: str, loaded_at: datetime | None = None
) -> int:
    """Replace one month in the raw table; rows loaded."""
    return load_months(spark, {month: path}, table, loaded_at)[month]
