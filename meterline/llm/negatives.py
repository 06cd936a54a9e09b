"""Hard negatives: for an anchor and each of its positives, the best rows of other labels that score little less.

Vectors become whole numbers, floor(``SCALE`` * x), and a score is the exact inner product. An anchor's positives
are the best other rows of its label; the negatives of a positive are the best rows of other labels with scores from
``LOWEST`` percent of the positive's score up to that score.

Scores are bounded by segment summaries. A vector is cut into 1, 4 and 16 segments; of each its mean and its deviation
are stored. The inner product of two segments of n components is n times the product of their means, plus or minus
at most n times the product of their deviations. A pair is bounded by one segment first; pairs that the bounds of a
level leave open go to the next, finer one, and only what 16 segments leave open is scored. For positives
a pair is open while its upper bound reaches the scores of pairs already scored; for negatives while its bounds reach
into the scores allowed. The bounds only spare work: rows found are those of a full comparison.

All rows are compared with all anchors of the query set in blocks: lots of about ``LOT`` anchors meet shelves of about
``SHELF`` rows, both dealt out by a hash of the whole row, so no key fills a group; positives meet within one
label only. Only the best rows of a group leave its task.

Defined cases: rows without id or label, and vectors that are null, empty, of another length than most, or hold null or
non-finite components, take no part. Components of ``vectors.LARGEST`` or more raise an error. Rows that repeat id, label and
vector are one; of rows that share an id, each is a row of its own, and ties among them go by a hash of the row. An
anchor without positives, or a positive without negatives, has no rows. Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import mapped, ship, stored
from meterline.llm.vectors import matrix, whole_numbers

SCALE, LEVELS = 256, (1, 4, 16)
POSITIVES, NEGATIVES, LOWEST = 5, 5, 80
LOT, SHELF = 4096, 8192

_ROW = "vec_id long, tie long, label long, v array<long>, means array<double>, deviations array<double>"


def _cuts(length: int, segments: int) -> np.ndarray:
    return np.arange(min(segments, length) + 1) * length // min(segments, length)


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each vector's segments, level after level."""
    means, deviations = [], []
    for segments in LEVELS:
        cuts = _cuts(v.shape[1], segments)
        for a, b in zip(cuts, cuts[1:]):
            means.append(v[:, a:b].mean(1))
            deviations.append(v[:, a:b].std(1))
    return np.stack(means, 1), np.stack(deviations, 1)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            columns = {name: batch.column(name) for name in ("vec_id", "tie", "label", "v")}
            for name, x in zip(("means", "deviations"), summaries(matrix(batch.column("v")))):
                first = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                columns[name] = pa.ListArray.from_arrays(first, pa.array(x.ravel(), pa.float64()))
            yield pa.record_batch(columns)


class Rows:
    """The rows of a group, with the bounds of their scores against one other row."""

    def __init__(self, table: pa.Table) -> None:
        self.ids, self.ties, self.labels = (table.column(c).to_numpy() for c in ("vec_id", "tie", "label"))
        self.v = matrix(table.column("v"))
        self.means, self.deviations = (matrix(table.column(c), np.float64) for c in ("means", "deviations"))
        self.levels, at = [], 0
        for segments in LEVELS:
            sizes = np.diff(_cuts(self.v.shape[1], segments)).astype(np.float64)
            self.levels.append((slice(at, at + len(sizes)), sizes))
            at += len(sizes)

    def bounds(self, level: int, at: np.ndarray, other: Rows, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the scores of the rows ``at`` with row i of ``other``."""
        columns, sizes = self.levels[level]
        middle = self.means[at, columns] @ (sizes * other.means[i, columns])
        spread = self.deviations[at, columns] @ (sizes * other.deviations[i, columns])
        spread = spread + 1 + 1e-9 * (np.abs(middle) + spread)  # more than rounding can make
        return middle - spread, middle + spread

    def scores(self, at: np.ndarray, other: Rows, i: int) -> np.ndarray:
        return self.v[at] @ other.v[i]

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in ``at`` of the k highest scores, ties by id."""
        if len(at) > k:  # what is below the k-th score cannot be among them
            top = np.flatnonzero(scores >= np.partition(scores, len(at) - k)[len(at) - k])
            return top[np.lexsort((self.ties[at[top]], self.ids[at[top]], -scores[top]))[:k]]
        return np.lexsort((self.ties[at], self.ids[at], -scores))

    def highest(self, at: np.ndarray, other: Rows, i: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of ``at`` that score best, and their scores."""
        least = -np.inf
        for level in range(len(LEVELS)):
            if len(at) <= k:
                break
            _, upper = self.bounds(level, at, other, i)
            # The k most promising rows are scored; no row below the worst of them can be among the best.
            promising = at[np.argpartition(upper, len(at) - k)[-k:]]
            least = max(least, self.scores(promising, other, i).min())
            at = at[upper >= least]
        scores = self.scores(at, other, i)
        place = self.best(at, scores, k)
        return at[place], scores[place]

    def within(self, at: np.ndarray, other: Rows, i: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``at`` whose score may lie in one of the spans, and their scores."""
        for level in range(len(LEVELS)):
            lower, upper = self.bounds(level, at, other, i)
            at = at[((upper[:, None] >= low) & (lower[:, None] <= high)).any(1)]
        return at, self.scores(at, other, i)


_POSITIVE = "vec_id long, tie long, other long, other_tie long, score long"
_NEGATIVE = "vec_id long, tie long, place int, other long, score long"


def _table(schema: str, columns: list[tuple[np.ndarray, ...]]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    parts = zip(*columns) if columns else [[np.empty(0, np.int64)]] * len(fields)
    return pa.table({name: pa.array(np.concatenate(list(x)), kind) for (name, kind), x in zip(fields, parts)})


def _positives(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            anchors, rows = Rows(left), Rows(right)
            for i in range(len(anchors.ids)):
                others = np.flatnonzero((rows.ids != anchors.ids[i]) | (rows.ties != anchors.ties[i]))
                at, scores = rows.highest(others, anchors, i, k)
                same = np.ones(len(at), np.int64)
                out.append((same * anchors.ids[i], same * anchors.ties[i], rows.ids[at], rows.ties[at], scores))
        return _table(_POSITIVE, out)

    return run


def _negatives(k: int, lowest: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            anchors, rows, reached = Rows(left), Rows(right), left.column("reached").to_pylist()
            for i in range(len(anchors.ids)):
                high = np.array(reached[i], np.int64)
                at, scores = rows.within(np.flatnonzero(rows.labels != anchors.labels[i]), anchors, i, high * lowest / 100 - 1, high)
                for place, most in enumerate(high.tolist()):
                    fits = np.flatnonzero((scores <= most) & (100 * scores >= lowest * most))
                    found = fits[rows.best(at[fits], scores[fits], k)]
                    same = np.ones(len(found), np.int64)
                    out.append((same * anchors.ids[i], same * anchors.ties[i], same * place, rows.ids[at[found]], scores[found]))
        return _table(_NEGATIVE, out)

    return run


def _met(anchors: DataFrame, rows: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    """``function`` of each lot of anchors and each shelf of rows."""
    spark = rows.sparkSession
    lots = -(-anchors.count() // LOT) or 1
    # Groups for all tasks of a shuffle where shelves are few.
    shelves = max(-(-rows.count() // SHELF), int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = lambda n: F.pmod(F.xxhash64("vec_id", "tie"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("lot", number(lots)).withColumn("shelf", each(shelves))
    right = rows.withColumn("shelf", number(shelves)).withColumn("lot", each(lots))
    ship(spark)
    keys = [*keys, "lot", "shelf"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(function, schema)


def _first(rows: DataFrame, keys: list[str], k: int, *ties: str) -> DataFrame:
    """The k rows of each key with the highest scores, with their ``rank`` from 1."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other", *ties))
    return rows.select("*", place.cast("int").alias("rank")).where(F.col("rank") <= F.lit(k))


def hard_negatives(
    vectors: DataFrame,
    label: Column | str = "label",
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; ``lowest``: percent of the positive's score.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = whole_numbers(vectors, SCALE, vec_id=F.col("vec_id").cast("long"), label=label.cast("long"), whole=F.col("embedding"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL")
    rows = rows.withColumn("tie", F.xxhash64("label", "whole")).select("vec_id", "tie", "label", "v").distinct()
    rows = stored(mapped(rows, _summarised, _ROW), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    key = ["vec_id", "tie"]
    best = _met(anchors, rows, ["label"], _positives(positives), _POSITIVE)
    best = stored(_first(best, key, positives, "other_tie"), "positives")
    # Of each anchor its positives' scores, best first; an anchor has no more than ``positives``.
    reached = best.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("reached"))
    reached = reached.withColumn("reached", F.transform("reached", lambda x: x["score"]))
    asked = stored(anchors.join(reached, key), "asked")
    found = _met(asked, rows, [], _negatives(negatives, lowest), _NEGATIVE)
    found = _first(found, [*key, "place"], negatives)
    pairs = best.select(
        *key, (F.col("rank") - 1).alias("place"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(pairs, [*key, "place"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def oracle_sql(every: int = 100) -> str:
    return f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
