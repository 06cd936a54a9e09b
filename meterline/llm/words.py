"""Words, word hashes and windows of words over Arrow batches of UTF-8 texts.

A word is a maximal run of bytes other than space and 0x09 to 0x0D. All work is done on whole
columns with numpy; a text is never decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_U = np.uint64
_BASE, STEP = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse modulo 2**64, raised to 0 .. n-1."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t))
        if size > 1 << 20:  # for one enormous word: not kept
            return tuple(tables)
        _powers[size] = tuple(tables)
    return _powers[size]


@dataclass
class Words:
    """The words of some documents: start and end byte of each, the first word of each document."""

    data: np.ndarray
    doc_bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever it stands; block by block, to bound memory."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + (1 << 20), "right")))
            part = self.data[low : self.ends[to - 1]]
            power, inverse = _power_tables(len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[_LOWER[part] if lower else part] * power[: len(part)], out=total[1:])
            s, e = self.starts[at:to] - low, self.ends[at:to] - low
            out[at:to] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _U(STEP))
            at = to
        return out

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of each window of ``n`` words inside one document, and the window's hash."""
        rolled = roll(hashes, n)
        inside = self.first[1:][self.doc_of_word()[: len(rolled)]] - np.arange(len(rolled)) >= n
        at = np.flatnonzero(inside)
        return at, mix(rolled[at] + _U(n))


def roll(h: np.ndarray, n: int, step: int = STEP) -> np.ndarray:
    """Sum of ``h[i + j] * step**j`` for j below n, from sums over windows that double in length."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, have, power, size = None, 0, h, 1  # power: sums over size words; out: over have words
    while True:
        if n & size:
            if out is None:
                out, have = power, size
            else:
                m = min(len(out), len(power) - have)
                out = out[:m] + _U(pow(step, have, 1 << 64)) * power[have : have + m]
                have += size
        if have == n:
            return out[: len(h) - n + 1]
        m = len(power) - size
        power = power[:m] + _U(pow(step, size, 1 << 64)) * power[size : size + m]
        size *= 2


def words_of(data: np.ndarray, doc_bytes: np.ndarray) -> Words:
    """``data``: the texts one after the other; ``doc_bytes``: where each begins, and the end."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[doc_bytes] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, doc_bytes, starts, ends, np.searchsorted(starts, doc_bytes))


def byte_runs(
    batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The binary column in runs of some megabytes: first row, last row + 1, bytes, where each row's begin."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The binary column in runs of rows: first row, last row + 1, their words."""
    for at, to, data, doc_bytes in byte_runs(batch, column, size):
        yield at, to, words_of(data, doc_bytes)


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a list column: row i holds ``values[first[i]:first[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed longs."""
    return np.ascontiguousarray(values).view(np.int64)
