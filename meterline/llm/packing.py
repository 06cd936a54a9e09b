"""Packing of token documents into training sequences of several context sizes.

Each task packs the documents it holds; nothing is shuffled. Documents are routed by length: whole
windows of the longest tier are cut off and stand alone, and what is left goes to the smallest tier that
holds it. Tiers are packed from the longest to the shortest. A window opened by a document of its tier
has a gap, which is filled from the shorter tiers: the longest remaining piece that fits, again and
again, and at last one piece cut to fill the window exactly; its rest is routed anew. When nothing
shorter is left the shortest piece of the own tier is cut instead. So all windows of a pool are full
but its last; that goes back to the next pool of the task, and at the task's end it is cut into windows
of shorter tiers and, below the shortest, of powers of two, so that nothing is padded.

Full windows are dealt to step groups of ``GROUP_IDS`` ids each, every group from windows of one tier,
so that all steps cost the same; only a tier's last group in a task may be smaller.

A pool holds the documents of about ``POOL_IDS`` ids, which bounds a task's memory; one longer document
is a pool of its own. All ids are packed, each once; ids within a document keep their order by ``start``.

Defined cases: null and empty texts hold the end id alone and are packed like others, as are rows with null or
repeated ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import mapped
from meterline.llm.tokens import encoded

TIERS = (1024, 512, 256, 128)
GROUP_IDS = 64 * 1024
POOL_IDS = 1 << 21

Piece = tuple[int, int, int]  # document, first id in it, number of ids


class Packer:
    """Windows of pieces from documents that are given by their lengths."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tiers
        # What waits, by length: (length, document, start), the shortest first; one list for each tier.
        self.waiting: list[list[tuple[int, int, int]]] = [[] for _ in tiers]

    def _tier(self, n: int) -> int:
        return max(t for t, size in enumerate(self.tiers) if size >= n)

    def _wait(self, piece: Piece) -> None:
        doc, start, n = piece
        insort(self.waiting[self._tier(n)], (n, doc, start))

    def route(self, doc: int, n: int) -> Iterator[list[Piece]]:
        """Whole windows of the document; the rest waits."""
        size = self.tiers[0]
        for start in range(0, n - size + 1, size):
            yield [(doc, start, size)]
        if n % size:
            self._wait((doc, n - n % size, n % size))

    def _longest(self, tier: int, most: int) -> Piece | None:
        """The longest waiting piece of this tier and shorter ones that is no longer than ``most``, taken out."""
        for t in range(tier, len(self.tiers)):
            at = bisect_right(self.waiting[t], (most, float("inf"), 0))
            if at:
                n, doc, start = self.waiting[t].pop(at - 1)
                return doc, start, n
        return None

    def _shortest(self, tier: int) -> Piece | None:
        """The shortest waiting piece of the shorter tiers, or else of this one, taken out."""
        for t in [*range(len(self.tiers) - 1, tier, -1), tier]:
            if self.waiting[t]:
                n, doc, start = self.waiting[t].pop(0)
                return doc, start, n
        return None

    def packed(self, last: bool) -> Iterator[list[Piece]]:
        """Full windows of all that waits; the one that stays open waits on, or at the end is cut up."""
        for t, size in enumerate(self.tiers):
            while self.waiting[t]:
                n, doc, start = self.waiting[t].pop()
                window, gap = [(doc, start, n)], size - n
                while gap and (piece := self._longest(t + 1, gap)):
                    window.append(piece)
                    gap -= piece[2]
                if gap and (piece := self._shortest(t)):
                    doc, start, n = piece
                    window.append((doc, start, min(n, gap)))
                    if n > gap:
                        self._wait((doc, start + gap, n - gap))
                    gap -= min(n, gap)
                while gap and (piece := self._shortest(t)):  # shorter than the gap: only when little is left
                    doc, start, n = piece
                    window.append((doc, start, min(n, gap)))
                    if n > gap:
                        self._wait((doc, start + gap, n - gap))
                    gap -= min(n, gap)
                if not gap:
                    yield window
                elif last:
                    yield from self._cut_up(window)
                else:
                    for piece in window:
                        self._wait(piece)
                    return

    def _cut_up(self, window: list[Piece]) -> Iterator[list[Piece]]:
        """An open window as full windows of shorter tiers, and of powers of two below the shortest."""
        rest = list(window)
        shorter = [1 << k for k in range((self.tiers[-1] - 1).bit_length() - 1, -1, -1)]
        for size in [*self.tiers, *shorter]:
            while sum(n for *_, n in rest) >= size:
                out, gap = [], size
                while gap:
                    doc, start, n = rest.pop(0)
                    out.append((doc, start, min(n, gap)))
                    if n > gap:
                        rest.insert(0, (doc, start + gap, n - gap))
                    gap -= min(n, gap)
                yield out


def _pieces(tokenizer: str, tiers: tuple[int, ...], group_ids: int):
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + [("context_size", pa.int32()), ("step_group", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(tiers)
        docs: dict[int, tuple[int | None, np.ndarray]] = {}  # those that wait: id and token ids
        sequences = groups = number = held = 0
        open_groups: dict[int, list[int]] = {}  # tier: group, its ids
        rows: list[list] = [[] for _ in schema]

        def put(window: list[Piece]) -> None:
            nonlocal sequences, groups
            total = sum(n for *_, n in window)
            size = total if total < tiers[-1] else min(t for t in tiers if t >= total)
            group = open_groups.get(size)
            if group is None or group[1] + size > group_ids:
                group = open_groups[size] = [groups, 0]
                groups += 1
            group[1] += size
            at = 0
            for doc, start, n in window:
                doc_id, ids = docs[doc]
                crc = zlib.crc32(ids[start : start + n])
                values = (doc_id, start, n, crc, len(ids), (task << 40) + sequences, at, size, (task << 40) + group[0])
                for column, value in zip(rows, values):
                    column.append(value)
                at += n
            sequences += 1

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema)
            for c in rows:
                c.clear()
            return out

        def settle(last: bool) -> pa.RecordBatch:
            for window in packer.packed(last):
                put(window)
            waiting = {doc for tier in packer.waiting for _, doc, _ in tier}
            for doc in [d for d in docs if d not in waiting]:
                del docs[doc]
            return flush()

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for low, high, ids, first in encoded(batch, "body", tokenizer):
                ids = ids.astype("<u4")
                for i in range(low, high):
                    own = ids[first[i - low] : first[i - low + 1]]
                    docs[number] = (names[i], own)
                    for window in packer.route(number, len(own)):
                        put(window)
                    number += 1
                held += len(ids)
                if held >= POOL_IDS:
                    yield settle(False)
                    held = 0
        yield settle(True)

    return run


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, group_ids: int = GROUP_IDS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context_size, step_group.

    ``context_size`` is that of the sequence's tier, or the power of two that it holds; every sequence is full.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body"))
    return mapped(
        rows,
        _pieces(tokenizer, tuple(sorted(tiers, reverse=True)), group_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "context_size int, step_group long",
    )
