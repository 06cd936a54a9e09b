"""Parquet tables with versions: partition replace, keyed upsert, appended columns, full rebuild, export.

A write puts its files into a folder of its own, where nobody reads yet. A version is a small JSON file that lists
the folders of a table, by month where the table has months; it is written aside and takes its number by one rename.
That rename is the commit: before it every reader sees the old rows, after it the new ones, however many months
changed. A job or driver that dies on the way leaves a folder that no version names.

A reader is bound to the folders of the version it found. Folders of the last ``KEEP`` versions stay, so a read that
started before a rebuild ends on the rows it started with. Older versions go with the next commit, and so do
folders that no version has named for ``ABANDONED_DAYS``.

Writers may also hold a version back: the ``stage_`` functions return a ``State`` that only ``commit`` makes visible.
There is one writer of a table at a time; a second one that commits the same number gets an error.
"""

from __future__ import annotations

import contextlib
import json
import logging
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.sources import files

log = logging.getLogger(__name__)

MONTH = "source_month"
KEEP = 3
ABANDONED_DAYS = 7
_VERSIONS = "_versions"
_WRITE = "write"
# A task's share of a month that is written again, in bytes of its files.
PIECE_BYTES = 32 << 20
_PIECE, _GONE = "_piece", "_gone"


@dataclass(frozen=True)
class Part:
    """A folder of a table; its month, rows and what the writer noted about them, where known."""

    folder: str
    month: date | None = None
    rows: int | None = None
    note: str | None = None


@dataclass(frozen=True)
class State:
    """The rows of a table at one version."""

    path: str
    schema: T.StructType
    parts: tuple[Part, ...] = ()

    @property
    def months(self) -> list[date]:
        return sorted({p.month for p in self.parts if p.month is not None})

    def of(self, months: Iterable[date]) -> State:
        """The same table with the rows of these months only."""
        wanted = set(months)
        return replace(self, parts=tuple(p for p in self.parts if p.month in wanted))

    def noted(self, months: Iterable[date], note: dict[date, str]) -> State:
        """The same rows, with notes on those of some months."""
        marked = set(months)
        return replace(self, parts=tuple(replace(p, note=note[p.month]) if p.month in marked else p for p in self.parts))

    def to_json(self) -> dict:
        parts = [{"folder": p.folder, "month": p.month and p.month.isoformat(), "rows": p.rows, "note": p.note} for p in self.parts]
        return {"schema": self.schema.jsonValue(), "parts": parts}

    @classmethod
    def from_json(cls, path: str, value: dict) -> State:
        parts = (Part(p["folder"], p["month"] and date.fromisoformat(p["month"]), p["rows"], p["note"]) for p in value["parts"])
        return cls(path, T.StructType.fromJson(value["schema"]), tuple(parts))


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


# Versions.


def versions(spark: SparkSession, path: str) -> list[int]:
    names = files.file_names(spark, f"{path}/{_VERSIONS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_version(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(files.read_text(spark, _version_file(path, version)))


def write_version(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Make a version visible, by one rename."""
    target = _version_file(path, version)
    aside = f"{path}/{_VERSIONS}/.{version}-{uuid.uuid4().hex}"
    files.write_text(spark, aside, json.dumps(content))
    if files.exists(spark, target):
        files.delete(spark, aside)
        raise Conflict(f"version {version} of {path} was committed by another writer")
    files.rename(spark, aside, target)


def _version_file(path: str, version: int) -> str:
    return f"{path}/{_VERSIONS}/{version:012d}.json"


def current(spark: SparkSession, path: str, version: int | None = None) -> State | None:
    """The newest version of a table, or a given one that is still kept; None where there is no table."""
    known = versions(spark, path)
    if not known:
        return None
    return State.from_json(path, read_version(spark, path, known[-1] if version is None else version))


def commit(spark: SparkSession, state: State, version: int | None = None) -> int:
    """Make a state the newest version of its table; its number."""
    known = versions(spark, state.path)
    if version is None:
        version = known[-1] + 1 if known else 1
    write_version(spark, state.path, version, state.to_json())
    _clear(spark, state.path, [*known, version])
    return version


def forget(spark: SparkSession, path: str) -> None:
    """Delete versions before the last ``KEEP``."""
    for version in versions(spark, path)[:-KEEP]:
        files.delete(spark, _version_file(path, version))


def _clear(spark: SparkSession, path: str, known: list[int]) -> None:
    """Delete versions before the last ``KEEP``, and the folders that no version names."""
    forget(spark, path)
    kept = [current(spark, path, version) for version in known[-KEEP:]]
    named = {p.folder for state in kept for p in state.parts}
    writes = {folder.split("/")[0] for folder in named}
    oldest = files.modified(spark, _version_file(path, known[-KEEP:][0]))
    abandoned = time.time() - ABANDONED_DAYS * 86400
    for name in files.child_folders(spark, path):
        if not name.startswith(f"{_WRITE}=") or name in named:
            continue
        if name in writes:
            # Some months of this write may have been replaced since.
            if len(known) > KEEP:
                for child in files.child_folders(spark, f"{path}/{name}"):
                    if f"{name}/{child}" not in named:
                        files.delete(spark, f"{path}/{name}/{child}")
            continue
        # A folder older than the oldest version was named by one that is gone, unless its writer is still at work.
        changed = files.modified(spark, f"{path}/{name}")
        if changed < abandoned or (len(known) > KEEP and changed < oldest and _finished(spark, f"{path}/{name}")):
            files.delete(spark, f"{path}/{name}")


def _finished(spark: SparkSession, folder: str) -> bool:
    return files.exists(spark, f"{folder}/_SUCCESS")


# Reading.


def read_state(spark: SparkSession, state: State) -> DataFrame:
    """The rows of one version, whatever is committed later.

    The stored schema saves Spark from opening the footer of every file to merge them, and
    gives rows of files older than an appended column a NULL there.
    """
    folders = [f"{state.path}/{p.folder}" for p in state.parts]
    if not folders:
        return spark.createDataFrame([], state.schema)
    reader = spark.read.schema(state.schema)
    if state.parts[0].month is not None:
        reader = reader.option("basePath", state.path)
    return reader.parquet(*folders).select(*(f"`{c}`" for c in state.schema.names))


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A table written by this module, at its newest version or a given one."""
    state = current(spark, path, version)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_state(spark, state)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema the table was last written with, columns appended over time included."""
    state = current(spark, path)
    return state.schema if state else None


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def stored_months(spark: SparkSession, path: str) -> list[date]:
    """Months that have rows; no folder is listed."""
    state = current(spark, path)
    return state.months if state else []


def in_months(months: Iterable[date]):
    """Filter on literal months, which prunes partitions."""
    return F.col(MONTH).isin([F.lit(m) for m in sorted(months)])


def counted(spark: SparkSession, state: State) -> State:
    """The state with the rows of each part; those not known yet are counted from file footers, in one job."""
    unknown = [p for p in state.parts if p.rows is None]
    if not unknown:
        return state
    rows = read_state(spark, replace(state, parts=tuple(unknown)))
    if unknown[0].month is None:
        counts = {unknown[0].folder: rows.count()}
    else:
        places = spark.read.schema(state.schema).option("basePath", state.path)
        found = places.parquet(*(f"{state.path}/{p.folder}" for p in unknown)).groupBy(_WRITE, MONTH).count().collect()
        counts = {f"{_WRITE}={w}/{MONTH}={m.isoformat()}": n for w, m, n in found}
    return replace(state, parts=tuple(replace(p, rows=counts.get(p.folder, 0)) if p.rows is None else p for p in state.parts))


def month_rows(state: State | None, month: date) -> int:
    """Rows of one month of a counted state."""
    return sum(p.rows for p in state.parts if p.month == month) if state else 0


def row_count(spark: SparkSession, path: str, month: date) -> int:
    """Rows of one month, counted from the file footers of its parts at most."""
    state = current(spark, path)
    return month_rows(counted(spark, state.of([month])), month) if state else 0


# Writing.


def _only(months: Iterable[date]):
    """The month column; a row of another month, or of none, is an error."""
    stray = F.concat(F.lit("row outside the listed months: "), F.coalesce(F.col(MONTH).cast("string"), F.lit("NULL")))
    return F.when(in_months(months), F.col(MONTH)).otherwise(F.raise_error(stray).cast("date"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def evolved_schema(stored: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """Stored columns, then columns only the new rows have. Stored types stay."""
    incoming = _nullable(incoming)
    if stored is None:
        return incoming
    known = {f.name.lower() for f in stored}
    return T.StructType([*stored.fields, *(f for f in incoming if f.name.lower() not in known)])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; those ``df`` lacks are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *(
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        )
    )


def _new_write() -> str:
    return f"{_WRITE}=w{uuid.uuid4().hex}"


def _written_months(df: DataFrame, path: str, months: list[date], gather: bool) -> tuple[Part, ...]:
    """Write the rows of the listed months to a folder of their own; its parts."""
    df, write = df.withColumn(MONTH, _only(months)), _new_write()
    if gather:
        # One partition per month, which adaptive execution splits again where a month is large.
        df = df.hint("rebalance", F.col(MONTH))
    # Keys are most of a row; Zstandard halves their text, Snappy leaves it as it is.
    df.write.partitionBy(MONTH).option("compression", "zstd").parquet(f"{path}/{write}")
    prefix = f"{MONTH}="
    names = [n for n in files.child_folders(df.sparkSession, f"{path}/{write}") if n.startswith(prefix)]
    return tuple(Part(f"{write}/{n}", date.fromisoformat(n.removeprefix(prefix))) for n in names)


def stage_months(df: DataFrame, path: str, months: Iterable[date], base: State | None, *, gather: bool = True) -> State:
    """``base`` with the given months replaced by the rows of ``df``; nobody sees it before ``commit``.

    A listed month without rows is empty afterwards. A row of any other month fails the job. Columns that
    ``base`` has and ``df`` lacks stay. ``gather`` brings the rows of a month together before writing; not needed
    where few tasks have rows of a month.
    """
    months = sorted(months)
    schema = evolved_schema(base.schema if base else None, df.schema)
    fresh = _written_months(conform(df, schema), path, months, gather)
    kept = tuple(p for p in base.parts if p.month not in months) if base else ()
    return State(path, schema, kept + fresh)


def _pieces_of(spark: SparkSession, path: str, parts: list[Part]) -> int:
    """Tasks that share the rows of these parts."""
    return max(1, -(-sum(files.size_in_bytes(spark, f"{path}/{p.folder}") for p in parts) // PIECE_BYTES))


@contextlib.contextmanager
def _joined_as_dealt(spark: SparkSession) -> Iterator[None]:
    """Let a join keep an exchange by some of its keys, instead of one by all of them."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _dealt(df: DataFrame, key: str, pieces: dict[date, int]) -> DataFrame:
    """Rows dealt out by month and, where a month has several ``pieces``, by key: joined and written as they lie."""
    several = F.create_map(*(F.lit(x) for item in pieces.items() for x in item))
    piece = F.pmod(F.xxhash64(key), F.element_at(several, F.col(MONTH)))
    return df.withColumn(_PIECE, piece).repartition(MONTH, _PIECE)


def stage_upsert(
    batch: DataFrame, path: str, key: str, months: Iterable[date], base: State | None, *, gather: bool = True
) -> State:
    """``base`` without the rows whose key is in the batch, and with the batch.

    Equal keys must share a month, which keeps the work inside ``months``. The batch is computed once: its keys are
    read back from the files it was written to. Old rows that stay are shuffled once, for the join with those keys and
    for their files alike, and written beside it. ``gather`` as of ``stage_months``, for the batch.
    """
    spark, months = batch.sparkSession, sorted(months)
    staged = stage_months(batch, path, months, base, gather=gather)
    known = {p.folder for p in base.parts} if base else set()
    fresh = replace(staged, parts=tuple(p for p in staged.parts if p.folder not in known))
    # A month the batch has no rows of keeps its old ones as they are.
    changed = set(fresh.months)
    same = [p for p in base.parts if p.month in months and p.month not in changed] if base else []
    old = [p for p in base.parts if p.month in changed] if base else []
    rest: tuple[Part, ...] = ()
    if old:
        # Distinct keys are combined before the shuffle, so a key with many copies stays cheap.
        keys = read_state(spark, fresh).select(MONTH, key).distinct()
        rows = conform(read_state(spark, replace(base, parts=tuple(old))), staged.schema)
        pieces = {month: _pieces_of(spark, path, [p for p in old if p.month == month]) for month in sorted(changed)}
        rows, keys = _dealt(rows, key, pieces), _dealt(keys, key, pieces)
        # An anti join would be moved below the rows' exchange and need another; a left join stays above it.
        found = rows.join(keys.withColumn(_GONE, F.lit(True)), [MONTH, _PIECE, key], "left")
        kept = found.where(F.col(_GONE).isNull()).select(*staged.schema.names)
        with _joined_as_dealt(spark):
            rest = _written_months(kept, path, sorted(changed), False)
    return replace(staged, parts=(*staged.parts, *same, *rest))


def stage_rebuild(df: DataFrame, path: str) -> State:
    """All rows of a table anew; nobody sees them before ``commit``, so ``df`` may read the table it replaces."""
    write = _new_write()
    df.write.parquet(f"{path}/{write}")
    return State(path, _nullable(df.schema), (Part(write),))


def stage_split(df: DataFrame, path: str, column: str, base: State | None, keep: str) -> State:
    """Rows of a table written apart by the values of a text column, which is not stored but noted.

    Of ``base``, the folders noted as ``keep`` stay as they are; the others are replaced.
    """
    write, prefix = _new_write(), f"{column}="
    df.write.partitionBy(column).parquet(f"{path}/{write}")
    names = [n for n in files.child_folders(df.sparkSession, f"{path}/{write}") if n.startswith(prefix)]
    fresh = tuple(Part(f"{write}/{n}", note=n.removeprefix(prefix)) for n in names)
    kept = tuple(p for p in base.parts if p.note == keep) if base else ()
    return State(path, _nullable(df.drop(column).schema), kept + fresh)


def write_months(df: DataFrame, path: str, months: Iterable[date], *, gather: bool = True) -> None:
    """Replace the given months by the rows of ``df``, all at once; others stay as they are."""
    spark = df.sparkSession
    commit(spark, stage_months(df, path, months, current(spark, path), gather=gather))


def upsert_by_key(batch: DataFrame, path: str, key: str, months: Iterable[date], *, gather: bool = True) -> None:
    """Delete the target rows whose key is in the batch and insert the batch, at once."""
    spark = batch.sparkSession
    commit(spark, stage_upsert(batch, path, key, months, current(spark, path), gather=gather))


def overwrite_table(df: DataFrame, path: str) -> None:
    """Rebuild a whole table; the old rows serve readers until the new ones are complete."""
    commit(df.sparkSession, stage_rebuild(df, path))


def export_parquet(df: DataFrame, path: str) -> None:
    """Write ZSTD-compressed Parquet files."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
