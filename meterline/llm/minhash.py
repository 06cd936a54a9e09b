"""Near-duplicate groups of documents: fast similarity sketches, banding, exact verification.

A document's set holds its distinct runs of five words (lower-cased ASCII; shorter documents: all
their words as one run). Its sketch has ``BANDS * ROWS`` coordinates, filled in rounds: in round i
every element is thrown into one random bin with a random value, and a bin keeps the smallest value
of the earliest round that reached it. After as many rounds as bins, a second lot of rounds throws
everything into one bin each, so every bin is filled even for a set of one element; the estimate is
as concentrated as that of independent hash functions, at a cost of n + t log t instead of n * t.

Documents that agree in all rows of some band are candidates; candidates are linked when their full
sets have ``100 * |A & B| >= percent * |A | B|``. With 25 bands of 5 rows a pair at 0.85 is missed
with a probability of 4e-7, at 0.9 of 5e-10; with 31 bands of 4 rows, for lower limits, one at 0.80 with 8e-8; sets are held as 64-bit hashes of the runs.

No bucket is expanded into pairs of documents. Documents with equal sets count as one from the start. Those that
share buckets are laid together in blocks of about ``BLOCK`` set elements, and blocks are compared with
each other inside a task, which gives back only links that join what was apart. In round k about 16**k blocks
of each bucket (at least one) are compared with the bucket's others, and leave it; pairs of blocks all in
one component, or compared before, are passed over, and a bucket in one component is done. Each pair of
documents in a bucket is thus compared or found linked; components come out whole.

Defined cases: null or empty texts and texts without words have an empty set and are linked with
nothing. Rows without id take no part: component NULL, kept. Rows that repeat an id are one
document with several texts. Ties (which copy stays) go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import mapped, stored
from meterline.llm.words import chunks, lists, mix, signed

SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 25, 5
_T = BANDS * ROWS
_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * _T + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOW = _U(0xFFFFFFFF)
GROWTH, BLOCK = 16, 1 << 16


def sketch(x: np.ndarray) -> np.ndarray:
    """The sketch of a set of distinct 64-bit values: round and value of each bin."""
    bins = np.full(_T, np.iinfo(np.uint64).max, np.uint64)
    done = 0
    while done < _T and (bins == np.iinfo(np.uint64).max).any():
        to = min(_T, done + 1 + 6 * _T // len(x))
        h = mix(x[None, :] ^ _SEEDS[done:to, None])
        value = (np.arange(done, to, dtype=np.uint64)[:, None] << _U(32)) | (h & _LOW)
        np.minimum.at(bins, (((h >> _U(32)) * _U(_T)) >> _U(32)).astype(np.intp).ravel(), value.ravel())
        done = to
    for b in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        h = mix(x ^ _SEEDS[_T + b])
        bins[b] = (_U(_T + b) << _U(32)) | (h & _LOW).min()
    return bins


def band_keys(bins: np.ndarray, bands: int = BANDS, rows_each: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows, key = mix(bins[: bands * rows_each]).reshape(bands, rows_each), np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows_each):
        key = mix(key * _U(0xD1342543DE82EF95) + rows[:, r])
    return key


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and the sets, as sorted hashes, of runs of rows."""
    for at, to, words in chunks(batch, "body"):
        h = words.hashes(lower=True)
        place, key = words.windows(h, SHINGLE)
        bounds = np.searchsorted(place, words.first)
        sets = []
        for i in range(to - at):
            n = words.first[i + 1] - words.first[i]
            if n >= SHINGLE:
                sets.append(np.unique(key[bounds[i] : bounds[i + 1]]))
            else:  # all words as one run
                whole = np.full(min(n, 1), n, np.uint64)
                for w in h[words.first[i] : words.first[i + 1]]:
                    whole = mix((whole + w) * _U(0x9E3779B97F4A7C15))
                sets.append(whole)
        yield at, sets


def _sketched(bands: int, rows_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _sets(batch):
                n = np.array([len(x) for x in sets], np.int64)
                sums = np.array([[mix(x).sum(), mix(~x).sum()] if len(x) else [0, 0] for x in sets], np.uint64)
                keys = [band_keys(sketch(x), bands, rows_each) for x in sets if len(x)]
                first = np.concatenate([[0], np.cumsum((n > 0) * bands)])
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(at, len(sets)),
                        "n": n,
                        "set1": signed(sums[:, 0]),
                        "set2": signed(sums[:, 1]),
                        "bands": lists(signed(np.concatenate([np.empty(0, np.uint64), *keys])), first, pa.int64()),
                    }
                )

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, sets in _sets(batch):
            items = pa.array([x.tobytes() for x in sets], pa.binary())
            yield pa.record_batch({**{c: batch.column(c).slice(at, len(sets)) for c in ("rep", "block")}, "items": items})


def _links(a: list[np.ndarray], b: list[np.ndarray], same: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Places of linked sets, one in each list; with ``same``, one list with itself."""
    n_b = np.array([len(x) for x in b], np.int64)
    items, owner = np.concatenate(b), np.repeat(np.arange(len(b)), n_b)
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    for i, x in enumerate(a):
        fits = 100 * np.minimum(len(x), n_b) >= percent * np.maximum(len(x), n_b)
        if same:
            fits[: i + 1] = False
        if fits.any():
            low, high = np.searchsorted(items, x, "left"), np.searchsorted(items, x, "right")
            n = high - low
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            both = np.bincount(owner[at], minlength=len(b))
            for j in np.flatnonzero(fits & (100 * both >= percent * (len(x) + n_b - both))):
                yield i, int(j)


def _stars(links: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The smallest id of each group of linked ids, and each other id of it."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return ((top(x), x) for x in list(up) if top(x) != x)


def _compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = row["a_sets"]
                b = row["b_sets"] or a
                sets = [[np.frombuffer(x["items"], np.uint64) for x in side] for side in (a, b)]
                same, reps = row["b_sets"] is None, [x["rep"] for x in a] + [x["rep"] for x in b]
                shift = 0 if same else len(a)
                found = list(_stars((reps[i], reps[j + shift]) for i, j in _links(*sets, same, percent)))
                yield pa.record_batch(
                    {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
                )

    return run


def _body(docs: DataFrame) -> DataFrame:
    """Id and text alone, under names of our own."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body")
    )


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) between ids -> rep, component: the smallest id reachable.

    Each round takes the smallest label among an id and its neighbours and then that label's own label, until
    no label falls any more; stars take two rounds, a long chain about the logarithm of its length.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    both = stored(both.union(edges.select("a", F.col("a").alias("b"))).union(edges.select("b", F.col("b").alias("a"))).distinct(), "edges")
    labels, total = stored(both.groupBy("a").agg(F.min("b").alias("l")), "labels"), None
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("l"))
        jump = labels.select(F.col("a").alias("l"), F.col("l").alias("next"))
        labels = stored(near.join(jump, "l").select("a", F.least("l", "next").alias("l")), "labels")
        before, total = total, labels.agg(F.sum(F.col("l").cast("decimal(38,0)"))).head()[0]
        if total == before:
            return labels.select(F.col("a").alias("rep"), F.col("l").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows_each: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the group), kept (is that document).

    ``bands * rows_each`` is at most that of the defaults.
    """
    body = _body(docs)
    sketches = stored(
        mapped(body, _sketched(bands, rows_each), "doc_id long, n long, set1 long, set2 long, bands array<long>"), "sketches"
    )
    usable = sketches.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        usable.groupBy("n", "set1", "set2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    of_rep = _components_of(body, classes.select("rep", "n", "bands"), percent)
    classes = classes.select("n", "set1", "set2", "rep")
    classes = classes.join(of_rep, "rep", "left").select(
        "n", "set1", "set2", F.coalesce("component", "rep").alias("component")
    )
    grouped = usable.drop("bands").join(classes, ["n", "set1", "set2"]).select("doc_id", "n", "component")
    single = sketches.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component"))
    return grouped.unionByName(single).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _blocks(body: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """bucket, block, rep of each member; block and its sets (rep, items)."""
    # Near duplicates share the smallest head of their buckets.
    homes = stored(members.groupBy("rep", "n").agg(F.min("lead").alias("home")), "homes")
    parts = homes.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("rep"), F.col("parts")))
    homes = stored(homes.join(parts, "home").select("rep", block.alias("block")), "homes")
    # Texts are large at any size of the other side, so both sides are shuffled however small it is.
    wanted = body.join(homes.select(F.col("rep").alias("doc_id"), "block").hint("merge"), "doc_id")
    wanted = wanted.select(F.col("doc_id").alias("rep"), "block", "body")
    sets = mapped(wanted, _hashed, "rep long, block long, items binary")
    sets = sets.groupBy("block").agg(F.collect_list(F.struct("rep", "items")).alias("sets"))
    return stored(members.select("bucket", "rep").join(homes, "rep"), "members"), stored(sets, "sets")


def _components_of(body: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """rep, component of each class that is linked with another; rep: smallest id of the class."""
    buckets = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("size"))
    members, sets = _blocks(body, stored(buckets.join(heads.where("size > 1").drop("size"), "bucket"), "members"))
    links, seen, found, turn = None, None, None, 0
    while True:
        # Blocks of each bucket that still holds several components.
        placed = members.withColumn("component", F.col("rep"))
        if found is not None:
            placed = members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        placed = placed.groupBy("bucket", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        live = placed.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("size"), F.min("block").alias("first"),
            F.min("low").alias("least"), F.max("high").alias("most"),
        )
        placed = stored(placed.join(live.where("least < most").drop("least", "most"), "bucket"), "placed")
        if placed.isEmpty():
            return found if found is not None else members.select("rep", F.col("rep").alias("component")).limit(0)
        lot = F.pmod(F.xxhash64("block", F.lit(turn)), F.lit(1 << 30)) * F.col("size") < F.lit(GROWTH**turn << 30)
        lot = lot | (F.col("block") == F.col("first"))
        one = placed.where(lot).select("bucket", F.col("block").alias("x"), F.col("low").alias("x_low"), F.col("high").alias("x_high"))
        other = placed.select("bucket", F.col("block").alias("y"), "low", "high")
        pairs = one.join(other, "bucket").where("least(low, x_low) < greatest(high, x_high)")
        pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        pairs = stored(pairs if seen is None else pairs.join(seen, ["x", "y"], "left_anti"), "pairs")
        new = stored(_linked(pairs, sets, percent), "links")
        links, seen = (new, pairs) if links is None else (links.unionByName(new), seen.unionByName(pairs))
        found = components(links)
        rest = placed.where(~lot).select("bucket", "block")
        members = stored(members.join(rest, ["bucket", "block"], "left_semi"), "members")
        turn += 1


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of each pair of blocks, as many as join them."""
    a = sets.select(F.col("block").alias("x"), F.col("sets").alias("a_sets"))
    b = sets.select(F.col("block").alias("y"), F.col("sets").alias("b_sets"))
    own = pairs.where("x = y").join(a, "x").select("a_sets", F.lit(None).cast(b.schema["b_sets"].dataType).alias("b_sets"))
    two = pairs.where("x <> y").join(a, "x").join(b, "y").select("a_sets", "b_sets")
    return mapped(own, _compared(percent), "a long, b long").unionByName(mapped(two, _compared(percent), "a long, b long"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows_each: int = ROWS) -> DataFrame:
    """All columns of the documents that stay: one of each group, and those without id."""
    gone = near_duplicates(docs, percent, bands, rows_each).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
