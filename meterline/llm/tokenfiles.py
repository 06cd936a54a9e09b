"""Token ids in compact binary files, and back.

A file holds segments: runs of whole documents of about ``SEGMENT_IDS`` ids. A segment is

    header    "PFR1", number of documents, of ids, of blocks (4 x uint32)
    documents ids of each, with the end id (uint32 each)
    index     where each block begins, counted from the first block (uint32 each, and the end)
    blocks    of ``BLOCK`` ids, the last one shorter

and a block, in patched frame-of-reference form,

    minimum (uint32), width in bits (uint8), number of exceptions (uint16)
    exceptions: places in the block (uint16 each), then what is left above the width (uint32 each)
    the low bits of all ids less the minimum, packed at the width

The width is that of the ``PERCENTILE``-th percentile of the block's ids less the minimum; ids beyond
it are exceptions and are patched in. The index lets a reader open any block by itself.

Segments are rows of Parquet files (one binary column, stored as they are) that Spark writes and
commits, so the files live wherever Spark can write, and lost tasks are run again. Documents are in
ascending order of id, cut into as many files as tasks; documents of one id may be cut apart, by the hash
of their text. The ids of a file are counted when it is read, and files' totals, one row for each
file, give the place of each document among all.

Defined cases: null and empty texts hold the end id alone. Null ids come first; equal ids stand by the
hash of the text; equal rows stand next to each other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.storage import mapped
from meterline.llm.tokens import encoded

BLOCK, PERCENTILE, SEGMENT_IDS = 1024, 90, 1 << 20
_MAGIC = b"PFR1"
_SEGMENT = "file int, segment int, n_ids long, doc_ids array<long>, payload binary"


def _packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, highest first."""
    size = 2 if width <= 16 else 4
    bits = np.unpackbits(values.astype(f">u{size}").view(np.uint8).reshape(-1, size), axis=1)
    return np.packbits(bits[:, 8 * size - width :]).tobytes()


def _unpacked(data: bytes, width: int, n: int) -> np.ndarray:
    size = 2 if width <= 16 else 4
    bits = np.zeros((n, 8 * size), np.uint8)
    if width:
        bits[:, 8 * size - width :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(bits, axis=1).view(f">u{size}").ravel().astype(np.uint32)


def encode_block(ids: np.ndarray) -> bytes:
    low = ids.min()
    rest = ids - low
    place = min(len(rest) - 1, len(rest) * PERCENTILE // 100)
    width = int(np.partition(rest, place)[place]).bit_length()
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    return b"".join(
        [
            struct.pack("<IBH", int(low), width, len(over)),
            over.astype("<u2").tobytes(),
            (rest[over] >> np.uint32(min(width, 31))).astype("<u4").tobytes(),
            _packed(rest, width),
        ]
    )


def decode_block(data: bytes, n: int) -> np.ndarray:
    low, width, over = struct.unpack_from("<IBH", data)
    at = 7
    places = np.frombuffer(data, "<u2", over, at)
    high = np.frombuffer(data, "<u4", over, at + 2 * over)
    out = _unpacked(data[at + 6 * over :], width, n)
    out[places] |= high << np.uint32(min(width, 31))
    return out + np.uint32(low)


def _halves(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 8 numbers as their bits in the highest bits of two 64-bit numbers a row, four in each."""
    parts = values.reshape(-1, 2, 4).astype(np.uint64)
    out = parts[:, :, 0]
    for k in range(1, 4):
        out = out << np.uint64(width) | parts[:, :, k]
    return out << np.uint64(64 - 4 * width)


def _packed_rows(values: np.ndarray, width: int) -> np.ndarray:
    """``_packed`` of each row, for widths from 1 to 16 and rows of a multiple of 8 values."""
    halves = _halves(values & np.uint32((1 << width) - 1), width)
    # Both halves are 4 * width bits: the second follows in the middle of a byte if the width is odd.
    whole, rest = divmod(4 * width, 8)
    out = np.zeros((len(halves), width), np.uint8)
    out[:, : whole + (rest > 0)] = halves[:, 0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, : whole + (rest > 0)]
    second = halves[:, 1] >> np.uint64(rest)
    out[:, whole + (rest > 0) :] = (halves[:, 1] << np.uint64(rest)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :whole]
    if rest:
        out[:, whole] |= (second >> np.uint64(56)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpacked_rows(data: np.ndarray, width: int) -> np.ndarray:
    """The values of each row of ``_packed_rows``."""
    rows = data.reshape(-1, width)
    whole, rest = divmod(4 * width, 8)
    halves = np.zeros((len(rows), 2, 8), np.uint8)
    halves[:, 0, : whole + (rest > 0)] = rows[:, : whole + (rest > 0)]
    halves[:, 1, : width - whole] = rows[:, whole:]
    bits = halves.view(">u8").astype(np.uint64).reshape(-1, 2)
    bits[:, 1] <<= np.uint64(rest)
    out = np.empty((len(rows), 2, 4), np.uint32)
    for k in range(4):
        out[:, :, k] = bits << np.uint64(k * width) >> np.uint64(64 - width)
    return out.reshape(len(data), -1)


def _encode_blocks(ids: np.ndarray) -> list[bytes]:
    """``encode_block`` of each row of ``BLOCK`` ids, all rows of one width together."""
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    place = BLOCK * PERCENTILE // 100
    widths = np.frexp(np.partition(rest, place, axis=1)[:, place].astype(np.float64))[1]
    out: list[bytes] = [b""] * len(ids)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        if not 1 <= width <= 16:
            for k in rows.tolist():
                out[k] = encode_block(ids[k])
            continue
        own = rest[rows]
        packed = _packed_rows(own, width)
        row, over = np.nonzero(own >> np.uint32(width))
        high = (own[row, over] >> np.uint32(width)).astype("<u4")
        over = over.astype("<u2")
        at = np.searchsorted(row, np.arange(len(rows) + 1)).tolist()
        for i, k in enumerate(rows.tolist()):
            a, b = at[i], at[i + 1]
            head = struct.pack("<IBH", int(low[k]), width, b - a)
            out[k] = b"".join([head, over[a:b].tobytes(), high[a:b].tobytes(), packed[i].tobytes()])
    return out


def _decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of each block of ``BLOCK`` ids, all blocks of one width together."""
    head = np.lib.stride_tricks.sliding_window_view(data, 7)[starts] if len(starts) else np.empty((0, 7), np.uint8)
    low, widths = head[:, :4].copy().view("<u4").ravel(), head[:, 4]
    over = head[:, 5:].copy().view("<u2").ravel().astype(np.int64)
    out = np.empty((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        at = starts[rows] + 7 + 6 * over[rows]
        size = BLOCK * width // 8
        if 1 <= width <= 16:
            out[rows] = _unpacked_rows(np.lib.stride_tricks.sliding_window_view(data, size)[at], width)
        else:
            for k, a in zip(rows.tolist(), at.tolist()):
                out[k] = _unpacked(data[a : a + size].tobytes(), width, BLOCK)
    # The exceptions of all blocks, one after the other.
    row = np.repeat(np.arange(len(starts)), over)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(over) - over, over)
    at = starts[row] + 7 + 2 * nth
    place = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    at = starts[row] + 7 + 2 * over[row] + 4 * nth
    high = sum(data[at + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4))
    out[row, place] |= high << np.minimum(widths[row], 31).astype(np.uint32)
    return out + low[:, None]


def encode_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    whole = len(ids) // BLOCK * BLOCK
    blocks = _encode_blocks(ids[:whole].reshape(-1, BLOCK)) if whole else []
    blocks += [encode_block(ids[whole:])] if whole < len(ids) else []
    index = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u4")
    head = struct.pack("<4s3I", _MAGIC, len(sizes), len(ids), len(blocks))
    return b"".join([head, sizes.astype("<u4").tobytes(), index.tobytes(), *blocks])


def _opened(data: bytes) -> tuple[np.ndarray, int, np.ndarray, int]:
    """Ids of each document, ids in all, block starts, where the first block begins."""
    magic, docs, ids, blocks = struct.unpack_from("<4s3I", data)
    if magic != _MAGIC:
        raise ValueError("not a segment of token ids")
    sizes = np.frombuffer(data, "<u4", docs, 16)
    index = np.frombuffer(data, "<u4", blocks + 1, 16 + 4 * docs)
    return sizes, ids, index, 16 + 4 * docs + 4 * (blocks + 1)


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each document has."""
    sizes, n, index, base = _opened(data)
    whole = n // BLOCK
    parts = [_decode_blocks(np.frombuffer(data, np.uint8), base + index[:whole].astype(np.int64)).ravel()] if whole else []
    if whole * BLOCK < n:
        parts.append(decode_block(data[base + int(index[whole]) :], n - whole * BLOCK))
    return np.concatenate([np.empty(0, np.uint32), *parts]), sizes


def read_ids(data: bytes, start: int, n: int) -> np.ndarray:
    """``n`` ids from place ``start`` of a segment; opens only the blocks that hold them."""
    _, total, index, base = _opened(data)
    first, last = start // BLOCK, (start + n - 1) // BLOCK
    parts = [
        decode_block(data[base + int(index[k]) : base + int(index[k + 1])], min(BLOCK, total - k * BLOCK))
        for k in range(first, last + 1)
    ]
    return np.concatenate(parts)[start - first * BLOCK :][:n]


def _segments(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, segment = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        names: list[pa.Array] = []
        held = 0

        def out() -> pa.RecordBatch:
            payload = encode_segment(np.concatenate(ids), np.concatenate(sizes))
            docs = pa.concat_arrays(names)
            return pa.record_batch(
                {
                    "file": pa.array([file], pa.int32()),
                    "segment": pa.array([segment], pa.int32()),
                    "n_ids": pa.array([sum(map(len, ids))], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                    "payload": pa.array([payload], pa.binary()),
                }
            )

        for batch in batches:
            for low, high, found, first in encoded(batch, "body", tokenizer):
                at = 0
                while at < high - low:
                    # Up to the document that fills the segment.
                    to = min(high - low, int(np.searchsorted(first, first[at] + SEGMENT_IDS - held)))
                    ids.append(found[first[at] : first[to]])
                    sizes.append(np.diff(first[at : to + 1]))
                    names.append(batch.column("doc_id").slice(low + at, to - at))
                    held += int(first[to] - first[at])
                    at = to
                    if held >= SEGMENT_IDS:
                        yield out()
                        segment, held = segment + 1, 0
                        ids.clear(), sizes.clear(), names.clear()
        if held:
            yield out()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """All documents' ids below ``path``, in ascending order of doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("body"), F.xxhash64(text).alias("tie")
    )
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    mapped(rows, _segments(tokenizer), _SEGMENT).write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids, sizes = decode_segment(row.column("payload")[0].as_py())
            first = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
            raw = ids.astype("<u4").tobytes()
            n = len(sizes)
            yield pa.record_batch(
                {
                    "file": pa.array(np.full(n, row.column("file")[0].as_py()), pa.int32()),
                    "segment": pa.array(np.full(n, row.column("segment")[0].as_py()), pa.int32()),
                    "doc_id": row.column("doc_ids").flatten(),
                    "start": pa.array(first[:-1], pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first, first[1:])], pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document in the files."""
    files = spark.read.schema(_SEGMENT).parquet(path)
    rows = mapped(
        files,
        _documents,
        "file int, segment int, doc_id long, start long, n_tokens long, ids_crc32 long",
    )
    # One row for each segment, of a million ids; files come in the order of their ids.
    sizes = files.select("file", "segment", "n_ids")
    per_file = sizes.groupBy("file").agg(F.sum("n_ids").alias("ids"))
    files_before = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    own = F.sum("n_ids").over(
        Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("file", "segment", F.coalesce(own, F.lit(0)).alias("in_file")).join(
        per_file.select("file", F.coalesce(files_before, F.lit(0)).alias("before")), "file"
    )
    starts = starts.select("file", "segment", (F.col("in_file") + F.col("before")).alias("base"))
    return rows.join(starts, ["file", "segment"]).select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )
