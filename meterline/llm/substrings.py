"""Word sequences that occur more than once, removed: windows found level by level, doubling in length.

A window of ``MIN_WORDS`` consecutive words that also starts anywhere else, in the same document or
another, is repeated; each word that a repeated window covers goes. Every window is judged on the
input, so the first occurrence goes like the others.

Level 1 looks at runs of 9 words. Not all: of the 27 that begin in a window, the one with the
smallest hash (its anchor; the last of equal ones) is found from the window's words alone, so equal
windows have equal anchors and a window whose anchor occurs once cannot be repeated. That leaves
about one run in 14. Level 2 extends the anchors that occur twice or more to 18 words, to the right and to
the left, and keeps those repeated on some side. The last level is the windows around these. It is spared
to most: an anchor whose whole surroundings, 61 words as far as its windows reach, stand elsewhere too
is settled, for all its windows do. Of the settled anchors only one of each surroundings, counting for two,
shows its windows to the open ones. At each level only what was repeated at the length before is
looked at, and the search ends when nothing is left. The last level compares 128 bits of hash, so unequal
windows are in effect never taken for equal; the levels before only narrow the search.

Counts are summed per task before they are shuffled, and repeated keys are written to tables, so that the joins that
find survivors have plain tables on both sides: adaptive execution splits these, and a window with a third of all
occurrences is no hot spot. The positions of one document meet in one row, as its text does.

Texts of any length are worked on whole, in memory of some times their size. Columns besides id and text do not matter;
an empty table gives an empty result.

Defined cases: null and empty texts, and texts of fewer words, lose nothing. Rows that repeat a document,
id and text, count as other places. Rows without id are treated like all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import dropped, mapped, stored
from meterline.llm.words import STEP, Words, chunks, lists, mix, roll, signed

MIN_WORDS = 35
_OTHER_STEP = 0x9FB21C651E98DF25
_NO_KEY = np.uint64(0)


def _anchor_length(min_words: int) -> int:
    """A quarter of the window, so that two doublings reach it."""
    return max(1, -(-min_words // 4))


def _anchors(words: Words, hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows (their first words) and the anchor of each; all anchors, and their hashes."""
    n = _anchor_length(min_words)
    runs = mix(roll(hashes, n) + np.uint64(n))
    at, _ = words.windows(hashes, min_words)
    if not len(at):
        return at, at, at, runs[:0]
    width = min_words - n + 1
    rank = np.lib.stride_tricks.sliding_window_view(runs, width)
    anchor = np.empty(len(at), np.int64)
    for low in range(0, len(at), 1 << 15):
        part = at[low : low + (1 << 15)]
        anchor[low : low + len(part)] = part + width - 1 - np.argmin(rank[part][:, ::-1], axis=1)
    every = np.unique(anchor)
    return at, anchor, every, runs[every]


def _places(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a chunk, by document: counted from its first word; where each document's begin."""
    bounds = np.searchsorted(at, words.first)
    return at - np.repeat(words.first[:-1], np.diff(bounds)), bounds


def _kept(text: bytes, gone: np.ndarray | None = None) -> bytes:
    words = text.split()  # bytes are split at the same six characters
    return b" ".join(words if gone is None else compress(words, (~gone).tolist()))


def _opened(column: pa.Array) -> pa.Array:
    """Compressed texts, as they were."""
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(x) if x else b"" for x in column.to_pylist()], pa.binary())


def _level1(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for low, high, words in chunks(batch, "body"):
                _, _, every, keys = _anchors(words, words.hashes(), min_words)
                places, bounds = _places(words, every)
                texts = batch.column("body").slice(low, high - low).to_pylist()
                yield pa.record_batch(
                    {
                        "uid": batch.column("uid").slice(low, high - low),
                        "doc_id": batch.column("doc_id").slice(low, high - low),
                        "n_words": pa.array(words.counts, pa.int64()),
                        "sha256": pa.array([hashlib.sha256(_kept(t)).digest() for t in texts], pa.binary()),
                        "packed": pa.array([pack(t) for t in texts], pa.binary()),
                        "places": lists(places, bounds, pa.int32()),
                        "keys": lists(signed(keys), bounds, pa.int64()),
                    }
                )

    return run


def _flat(column: pa.Array, first: np.ndarray) -> np.ndarray:
    """A list column of places as word numbers of the chunk."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy().astype(np.int64) + np.repeat(first[:-1], sizes)


def _level2(min_words: int):
    """Each repeated anchor's run, its extensions and its surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = _anchor_length(min_words)
        twice = min(2 * n, min_words)
        for batch in batches:
            batch = batch.append_column("body", _opened(batch.column("packed")))
            for low, high, words in chunks(batch, "body"):
                hashes = words.hashes()
                at = np.sort(_flat(batch.column("places").slice(low, high - low), words.first))
                doc = words.doc_of_word()[at]
                begin, end = words.first[doc], words.first[doc + 1]
                runs, middle = mix(roll(hashes, n) + np.uint64(n)), mix(roll(hashes, twice))
                right = np.where(at + twice <= end, middle[np.minimum(at, len(middle) - 1)] ^ np.uint64(1), _NO_KEY)
                back = at + n - twice
                left = np.where(back >= begin, middle[np.maximum(back, 0)] ^ np.uint64(2), _NO_KEY)
                low_, high_ = np.maximum(back - (min_words - twice), begin), np.minimum(at + min_words, end)
                around, around2 = _ranges(hashes, low_, high_), _ranges(mix(hashes), low_, high_)
                places, bounds = _places(words, at)
                yield pa.record_batch(
                    {
                        "uid": batch.column("uid").slice(low, high - low),
                        "places": lists(places, bounds, pa.int32()),
                        "keys": lists(signed(runs[at]), bounds, pa.int64()),
                        "rights": lists(signed(right), bounds, pa.int64()),
                        "lefts": lists(signed(left), bounds, pa.int64()),
                        "arounds": lists(signed(around), bounds, pa.int64()),
                        "arounds2": lists(signed(around2), bounds, pa.int64()),
                    }
                )

    return run


def _ranges(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of words of any lengths, by sums with a power for each place."""
    step = _OTHER_STEP
    power = np.full(len(hashes) + 1, step, np.uint64)
    inverse = np.full(len(hashes) + 1, pow(step, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    power, inverse = np.cumprod(power), np.cumprod(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1])])
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def _level3(min_words: int):
    """The windows of the given anchors: first word, hashes, and for how many each counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.append_column("body", _opened(batch.column("packed")))
            for low, high, words in chunks(batch, "body"):
                hashes = words.hashes()
                times = np.zeros(len(hashes), np.int32)
                column = batch.column("places").slice(low, high - low)
                times[_flat(column, words.first)] = batch.column("times").slice(low, high - low).flatten().to_numpy()
                at, anchor, _, _ = _anchors(words, hashes, min_words)
                near = times[anchor] > 0 if len(at) else np.empty(0, bool)
                at, anchor = at[near], anchor[near]
                places, bounds = _places(words, at)
                whole, whole2 = (mix(roll(hashes, min_words, s)) for s in (STEP, _OTHER_STEP))
                yield pa.record_batch(
                    {
                        "uid": pa.array(np.repeat(batch.column("uid").slice(low, high - low).to_numpy(), np.diff(bounds))),
                        "place": pa.array(places, pa.int32()),
                        "whole": signed(whole[at] if len(at) else whole[:0]),
                        "whole2": signed(whole2[at] if len(at) else whole2[:0]),
                        "times": pa.array(times[anchor], pa.int32()),
                    }
                )

    return run


def _removed(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.append_column("body", _opened(batch.column("packed")))
            for low, high, words in chunks(batch, "body"):
                n = high - low
                hashes = words.hashes()
                settled = np.zeros(len(hashes), bool)
                settled[_flat(batch.column("settled").slice(low, n), words.first)] = True
                at, anchor, _, _ = _anchors(words, hashes, min_words)
                at = at[settled[anchor]] if len(at) else at
                step = np.zeros(len(hashes) + 1, np.int32)
                for x in (at, np.unique(_flat(batch.column("windows").slice(low, n), words.first))):
                    np.add.at(step, x, 1)
                    np.add.at(step, x + min_words, -1)
                gone = np.cumsum(step[:-1]) > 0
                texts = batch.column("body").slice(low, n).to_pylist()
                kept = [_kept(t, gone[a:b]) for t, a, b in zip(texts, words.first, words.first[1:])]
                total = np.concatenate([[0], np.cumsum(gone)])[words.first]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(low, n),
                        "n_words": pa.array(words.counts, pa.int64()),
                        "n_removed": pa.array(np.diff(total), pa.int64()),
                        "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                        "kept_text": pa.array(kept, pa.binary()),
                    }
                )

    return run


def _twice(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, as a table: a join with plain tables on both sides can be split."""
    return stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "twice")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of each row.

    ``kept_text`` (bytes): the words that stay, joined by single spaces; NULL where all stay.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    body = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("body")
    )
    rows = stored(
        mapped(
            body,
            _level1(min_words),
            "uid long, doc_id long, n_words long, sha256 binary, packed binary, places array<int>, keys array<long>",
        ),
        "documents",
    )
    runs = rows.select("uid", F.explode(F.arrays_zip("places", "keys")).alias("a"))
    runs = runs.select("uid", F.col("a.places").alias("place"), F.col("a.keys").alias("key"))
    open_ = runs.join(_twice(runs, "key"), "key", "left_semi").groupBy("uid").agg(F.collect_set("place").alias("places"))
    open_ = stored(rows.select("uid", "doc_id", "packed").join(open_, "uid"), "open")
    names = ["key", "right", "left", "around", "around2"]
    anchors = mapped(
        open_.select("uid", "packed", "places"),
        _level2(min_words),
        "uid long, places array<int>, " + ", ".join(f"{n}s array<long>" for n in names[:4]) + ", arounds2 array<long>",
    )
    zipped = F.explode(F.arrays_zip("places", "keys", "rights", "lefts", "arounds", "arounds2")).alias("a")
    anchors = anchors.select("uid", zipped).select(
        "uid", F.col("a.places").alias("place"), F.col("a.keys").alias("key"), F.col("a.rights").alias("right"),
        F.col("a.lefts").alias("left"), F.col("a.arounds").alias("around"), F.col("a.arounds2").alias("around2"),
    )
    anchors = stored(anchors, "anchors")
    shown = stored(_shown(anchors), "shown")
    dropped(anchors)
    wanted = shown.where("times > 0").groupBy("uid").agg(F.collect_list(F.struct("place", "times")).alias("a"))
    wanted = wanted.select("uid", F.col("a.place").alias("places"), F.col("a.times").alias("times"))
    windows = mapped(
        open_.select("uid", "packed").join(wanted, "uid"),
        _level3(min_words),
        "uid long, place int, whole long, whole2 long, times int",
    )
    windows = stored(windows, "windows")
    found = windows.groupBy("whole", "whole2").agg(F.sum("times").alias("n")).where("n > 1").drop("n")
    found = stored(found, "found")
    repeated = windows.where("times = 1").join(found, ["whole", "whole2"], "left_semi").select("uid", "place")
    gone = shown.where("settled").select("uid", "place", F.lit(True).alias("settled"))
    gone = gone.unionByName(repeated.withColumn("settled", F.lit(False))).groupBy("uid").agg(
        F.collect_set(F.when(F.col("settled"), F.col("place"))).alias("settled"),
        F.collect_set(F.when(~F.col("settled"), F.col("place"))).alias("windows"),
    )
    gone = stored(gone, "gone")
    dropped(windows, shown)
    cut = mapped(
        open_.join(gone, "uid"),
        _removed(min_words),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text binary",
    )
    whole = rows.join(gone.select("uid"), "uid", "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lower(F.hex("sha256")).alias("kept_sha256"),
        F.lit(None).cast("binary").alias("kept_text"),
    )
    return whole.unionByName(cut)


def _shown(anchors: DataFrame) -> DataFrame:
    """uid, place, settled, times: settled anchors, and those that show their windows, with what each counts for."""
    around = anchors.groupBy("around", "around2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "place")).alias("one")
    )
    around = stored(around.where("n > 1"), "around")
    judged = anchors.join(around, ["around", "around2"], "left").select(
        "uid", "place", "key", "right", "left", F.col("n").isNotNull().alias("settled"),
        F.coalesce((F.col("one.uid") == F.col("uid")) & (F.col("one.place") == F.col("place")), F.lit(False)).alias("one"),
    )
    sides = F.explode(F.array("right", "left")).alias("side")
    every = anchors.select(sides).where("side <> 0")
    open_ = judged.where("NOT settled").select("uid", "place", "key", sides).where("side <> 0")
    # Plain tables again: what is summed up above a join would else keep it from being split.
    open_ = stored(open_.join(_twice(every, "side"), "side", "left_semi").select("uid", "place", "key"), "sides").distinct()
    one = judged.where("one").join(stored(open_.select("key").distinct(), "keys"), "key", "left_semi")
    kinds = [
        judged.where("settled").select("uid", "place", F.lit(True).alias("settled"), F.lit(0).alias("times")),
        one.select("uid", "place", F.lit(False).alias("settled"), F.lit(2).alias("times")),
        open_.select("uid", "place", F.lit(False).alias("settled"), F.lit(1).alias("times")),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
