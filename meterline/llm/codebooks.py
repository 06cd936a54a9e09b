"""Compression of vectors to one code byte for each part, with codebooks fitted on all rows.

Components become whole numbers, floor(``SCALE`` * x), and vectors are cut into ``PARTS`` equal consecutive parts. The
codebook of a part position starts as that part of the ``ENTRIES`` vectors with the smallest ids. Each round assigns
every part to the nearest entry of its codebook, then moves each entry to the floor of its parts' mean.

Nearest entries are found with value dictionaries: a block of rows has, for each dimension, a dictionary of its
distinct whole numbers and a table of the squared differences of each of these to that dimension of all
entries. The squared distance of a part to all entries is then the sum of one table row for each of its
dimensions, gathered by the part's dictionary codes; no component is subtracted or squared twice in a block.
Dictionaries belong to a block of at most ``BLOCK`` rows, so tables stay small whatever values the corpus holds.

Tasks add up the parts of each entry over all their blocks, and Spark adds up those sums: a round shuffles
PARTS * ENTRIES rows of each task. Codebooks, as bounded, are what the driver holds and sends out. All sums are exact,
so the result does not depend on how rows are dealt out.

Defined cases: vectors that are null, empty, of another length than most, or hold null or non-finite components are left out.
Components of ``vectors.LARGEST`` or more, and vectors that cannot be cut into equal parts, raise an error.
Rows that repeat an id stay rows of their own; among equal ids the smaller vector comes first, rows without id come last. With
fewer rows than entries, codebooks are that much shorter. Ties go to the entry with the lower index. Other
columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import mapped, stored
from meterline.llm.vectors import matrix, whole_numbers

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK, _ROWS = 8192, 1024


def _tables(part: np.ndarray, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each dimension: each row's code in the dictionary of values, and value by entry the squared difference."""
    for d in range(part.shape[1]):
        values, codes = np.unique(part[:, d], return_inverse=True)
        yield codes, (values[:, None] - book[None, :, d]) ** 2


def nearest_entries(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lowest of equally near ones, and the squared distance."""
    tables = list(_tables(part, book))
    # Sums that fit 32 bits are added up there, in half the memory.
    small = sum(int(t.max()) for _, t in tables) < 1 << 31
    tables = [(codes, t.astype(np.int32) if small else t) for codes, t in tables]
    index, far = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
    for low in range(0, len(part), _ROWS):
        rows = slice(low, low + _ROWS)
        total = tables[0][1][tables[0][0][rows]]
        for codes, table in tables[1:]:
            total += table[codes[rows]]
        index[rows] = total.argmin(1)
        far[rows] = np.take_along_axis(total, index[rows, None], 1)[:, 0]
    return index, far


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            yield batch.slice(low, BLOCK)


def _sums(books: np.ndarray):
    """Rows (part, entry, n, sum of each dimension) of a task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for block in _blocks(batches):
            v = matrix(block.column("v")).reshape(-1, parts, width)
            for p in range(parts):
                index, _ = nearest_entries(v[:, p], books[p])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                sums[p, used] += np.add.reduceat(v[order, p], first)
                n[p] += np.bincount(index, minlength=entries)
        at = np.nonzero(n)
        columns = {"part": at[0], "entry": at[1], "n": n[at]} | {f"s{d}": sums[at][:, d] for d in range(width)}
        yield pa.record_batch({name: pa.array(x, pa.int64()) for name, x in columns.items()})

    return run


def _assigned(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            v = matrix(block.column("v")).reshape(-1, parts, width)
            found = [nearest_entries(v[:, p], books[p]) for p in range(parts)]
            text = np.stack([index for index, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            error = sum(far for _, far in found)
            yield pa.record_batch(
                [*(block.column(c) for c in ("vec_id", "label")), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks over all rows (vec_id, v): part, entry, position within the part."""
    first = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    start = np.array([r.v for r in first], np.int64)
    if start.shape[1] % parts:
        raise ValueError(f"vectors of {start.shape[1]} components cannot be cut into {parts} equal parts")
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).swapaxes(0, 1))
    width = books.shape[2]
    names = ["n", *(f"s{d}" for d in range(width))]
    schema = ", ".join(f"{c} long" for c in ("part", "entry", *names))
    for _ in range(rounds):
        summed = mapped(rows.select("v"), _sums(books), schema).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names))
        for r in summed.collect():
            books[r.part, r.entry] = [r[f"s{d}"] // r.n for d in range(width)]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, label: Column | str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of each row, and the codebooks that ``code`` refers to."""
    if not 0 < entries <= 256:
        raise ValueError("a code byte names up to 256 entries")
    label = F.col(label) if isinstance(label, str) else label
    rows = stored(whole_numbers(vectors, SCALE, vec_id=F.col("vec_id").cast("long"), label=label), "vectors")
    books = fit(rows, parts, entries, rounds)
    kind = dict(rows.dtypes)["label"]
    schema = f"vec_id long, label {kind if kind != 'void' else 'string'}, code string, error long"
    if not books.size:
        return vectors.sparkSession.createDataFrame([], schema), books
    return mapped(rows, _assigned(books), schema), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows of its label, rows without label taken together."""
    coded = stored(coded, "codes")
    # Sums are stored, so that both sides of the join are plain tables and a label with most rows can be split.
    sums = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def oracle_sql() -> str:
    nearest = """
near_{k} AS MATERIALIZED (
  SELECT p, r, CAST(min(far) AS BIGINT) AS key FROM (
    SELECT a.p, a.r, (list_inner_product(a.v, a.v) - 2 * list_inner_product(a.v, b.v) + list_inner_product(b.v, b.v)) * 256 + b.e AS far
    FROM parts a JOIN book_{k} b USING (p)) GROUP BY p, r)"""
    moved = """
mean_{k} AS MATERIALIZED (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM (
    SELECT p, key % 256 AS e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT p, key, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM parts JOIN near_{k} USING (p, r)) GROUP BY ALL)
  GROUP BY ALL),
book_{n} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM book_{k} b LEFT JOIN mean_{k} m USING (p, e))"""
    rounds = ",".join(nearest.format(k=k) + "," + moved.format(k=k, n=k + 1) for k in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, CAST(p AS BIGINT) AS p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM kept, range({PARTS}) t(p)
), book_0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {ENTRIES}),
{rounds},
{nearest.format(k=ROUNDS)},
coded AS (
  SELECT r, string_agg(printf('%02x', key % 256), '' ORDER BY p) AS code, CAST(sum(key // 256) AS BIGINT) AS error
  FROM near_{ROUNDS} GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM book_{ROUNDS})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""
