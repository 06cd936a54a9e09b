"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

Vectors are centred, rotated to their principal axes and then by a rotation that is learned so that the signs
lose little (iterative quantisation); the signs are a code of ``BITS`` bits. The rotation is learned from the
``SAMPLE`` vectors with the smallest hashes, a bounded sample; all vectors are indexed. The Hamming radius is read
off the same sample: it holds ``COVER`` of its vectors' true nearest neighbours. Neighbours in all the
data are nearer than those in a sample, so recall there is higher.

Codes are cut into ``PARTS`` substrings, each with its own index of buckets by value. Of two codes within the
radius, some substring differs in at most radius // PARTS bits (pigeonhole). A query probes, for
each substring, all buckets within that many bits, keeps codes within the radius, and ranks them by
the true distance of the float vectors. A code that several substrings find is ranked for the first one only.
Queries with fewer results than asked for search once more, with the radius of all bits: that is every bucket, exact.

Equal vectors are one entry with its smallest ids, as many as can be asked for, so that a very common vector costs no
more than others; that loses nothing, as ties go to smaller ids. Buckets are cut into pieces of about ``PIECE``
entries by hash, and queries into lots, so that no task holds a whole bucket; only the best of each
piece and query leave the task.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without id. Rows that repeat an id and vector are one. With fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import mapped, ship, stored

BITS, PARTS, SAMPLE, COVER = 64, 8, 4096, 0.97
PIECE, LOT = 4096, 4096
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    # -0.0 and 0.0 are the same vector.
    rows = rows.select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1)
    found = lengths.collect()
    return rows.where(F.size("vector") == found[0]["length"]) if found else rows


class Codes:
    """The learned hash and radius."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, k: int = 10) -> None:
        self.mean = sample.mean(0)
        x = sample - self.mean
        _, _, axes = np.linalg.svd(x, full_matrices=False)
        rng = np.random.default_rng(SEED)
        axes = axes.T[:, :bits]
        if axes.shape[1] < bits:  # short vectors: more bits than axes
            axes = np.hstack([axes, axes @ rng.normal(size=(axes.shape[1], bits - axes.shape[1]))])
        turn, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
        z = x @ axes
        for _ in range(30):
            u, _, v = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
            turn = (u @ v).T
        self.matrix = axes @ turn
        self.radius = self._covering(sample, k)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """PARTS bytes for each vector."""
        return np.packbits((x - self.mean) @ self.matrix > 0, axis=1)

    def _covering(self, sample: np.ndarray, k: int) -> int:
        codes, found = self.codes(sample), []
        for low in range(0, len(sample), 256):
            part = sample[low : low + 256]
            far = (part**2).sum(1)[:, None] - 2 * part @ sample.T + (sample**2).sum(1)[None]
            far[np.arange(len(part)), np.arange(low, low + len(part))] = np.inf
            near = np.argpartition(far, min(k, len(sample) - 1), axis=1)[:, : min(k, len(sample) - 1)]
            found.append(hamming(codes[low : low + 256, None], codes[near]).ravel())
        found = np.concatenate(found)
        return int(np.quantile(found, COVER, method="higher")) if len(found) else BITS


_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[a ^ b].sum(-1, dtype=np.int64)


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def _probes(hash_: Codes, bits: int):
    """Rows (part, bucket) for each vector: its own buckets, or with ``bits`` all buckets within so many bits."""
    flips = np.array([sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(8), n)], np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = hash_.codes(_matrix(batch.column("vector")))
                n, times = len(codes), PARTS * len(flips)
                bucket = (codes[:, :, None] ^ flips).reshape(n * times)
                part = np.tile(np.repeat(np.arange(PARTS), len(flips)), n)
                yield pa.record_batch(
                    {
                        "entry": pa.array(np.repeat(batch.column("entry").to_numpy(), times)),
                        "part_bucket": pa.array(part * 256 + bucket, pa.int32()),
                        "code": pa.array(np.repeat(codes, times, axis=0).view(f"V{PARTS}").ravel().tolist(), pa.binary()),
                    }
                )

    return run


def _compared(radius: int, bits: int, k: int):
    def run(key: tuple, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": np.empty(0, np.int64), "entry": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(queries) or not len(entries):
            return empty
        part = int(key[0]) // 256
        q_code = np.frombuffer(b"".join(queries["code"]), np.uint8).reshape(-1, PARTS)
        e_code = np.frombuffer(b"".join(entries["code"]), np.uint8).reshape(-1, PARTS)
        q_vec, e_vec = np.stack(queries["vector"].to_numpy()), np.stack(entries["vector"].to_numpy())
        out = []
        for i in range(len(q_code)):
            apart = _ONES[e_code ^ q_code[i]]
            near = (apart.sum(1, dtype=np.int64) <= radius) & ~(apart[:, :part] <= bits).any(1)
            at = np.flatnonzero(near)
            if len(at):
                far = np.sqrt(((e_vec[at] - q_vec[i]) ** 2).sum(1))
                ids = entries["entry"].to_numpy()[at]
                best = np.lexsort((ids, far))[:k]
                out.append((np.full(len(best), queries["entry"].iloc[i]), ids[best], far[best]))
        if not out:
            return empty
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query", "entry", "score"), zip(*out))})

    return run


def _search(queries: DataFrame, entries: DataFrame, hash_: Codes, radius: int, k: int, pieces: int, lots: int) -> DataFrame:
    """query, entry (smallest ids of the vectors), score: the k best entries within the radius."""
    bits = min(8, radius // PARTS)
    schema = "entry long, part_bucket int, code binary"
    vectors = entries.select("entry", "vector")

    def spread(rows: DataFrame, bits: int, own: str, n: int, other: str, m: int) -> DataFrame:
        """Probes with their vectors; each is in one piece of its own side and meets all of the other's."""
        out = mapped(rows, _probes(hash_, bits), schema).join(rows, "entry")
        out = out.withColumn(own, F.pmod(F.xxhash64("entry"), F.lit(n)).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    left = spread(queries.select("entry", "vector"), bits, "lot", lots, "piece", pieces)
    right = spread(vectors, 0, "piece", pieces, "lot", lots)
    keys = ["part_bucket", "piece", "lot"]
    ship(queries.sparkSession)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _compared(radius, bits, k), "query long, entry long, score double"
    )
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "entry"))
    return found.select("*", place.alias("place")).where(F.col("place") <= F.lit(k)).drop("place")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) for the rows whose id is divisible by ``every``."""
    rows = stored(usable(vectors).distinct(), "vectors")
    # Equal vectors: the smallest ids, one more than asked for, as a query is no result of its own.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    entries = rows.select("vector", "vec_id", place.alias("place")).where(F.col("place") <= F.lit(k + 1))
    entries = entries.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries.select(F.element_at("ids", 1).alias("entry"), "ids", "vector"), "entries")
    asked = stored(
        rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector").join(entries.select("vector", "entry"), "vector")
        .select("vec_id", "entry"),
        "asked",
    )
    queries = entries.join(asked.select("entry").distinct(), "entry", "left_semi")
    sample = entries.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).collect()
    answer = "query_id long, rank int, vec_id long, score double"
    if len(sample) == 0:
        return vectors.sparkSession.createDataFrame([], answer)
    hash_ = Codes(np.array([r.vector for r in sample]), k=k)
    pieces = -(-entries.count() // (256 * PIECE))
    lots = -(-queries.count() // LOT)
    # A query's own vector is its first result, so one more is searched for.
    found = stored(_search(queries, entries, hash_, hash_.radius, k + 1, pieces, lots), "found")
    listed = found.join(entries.select("entry", "ids"), "entry")
    enough = listed.groupBy("query").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > k).select(F.col("query").alias("entry"))
    short = stored(queries.join(enough, "entry", "left_anti"), "short")
    if not short.isEmpty():
        again = stored(_search(short, entries, hash_, BITS, k + 1, pieces, lots), "found")
        kept = found.join(short.select(F.col("entry").alias("query")), "query", "left_anti")
        listed = kept.unionByName(again).join(entries.select("entry", "ids"), "entry")
    # Entries to ids, for each vector asked for once; then for each query without itself.
    order = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    by_vector = listed.select("query", "score", F.explode("ids").alias("vec_id"))
    by_vector = by_vector.select("*", order.alias("place")).where(F.col("place") <= F.lit(k + 1)).drop("place")
    lists = by_vector.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    results = asked.withColumnRenamed("vec_id", "query_id").join(lists, F.col("entry") == F.col("query"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    results = results.select("query_id", F.posexplode(others).alias("at", "b"))
    return results.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
