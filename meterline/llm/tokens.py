"""Token ids of whole texts with the tokenizers library.

A byte-level BPE file cuts a text, before any merge, in places that need no look at what stands
further away: before a space that no white space follows, before and after a line end that none
follows, and between a letter or digit and a sign. The ids of a text are therefore those
of the units between such places, one after the other. The cut before a line end is left out after a sign
of ASCII, where it changes nothing; after white space it keeps the line end from joining the rest of its run.

Units repeat a great deal: the library encodes each once per worker, and the rest is looked up. A worker keeps units
and ids of ``CACHE_BYTES`` at most, none longer than ``LONGEST_KEPT``, and starts anew beyond. New units go to the library
many at a time. Those that begin with a space and no other white space may follow anything, and those that neither begin
nor end with white space may stand after a line end of their own, so both are joined to texts; the bytes that each id stands
for tell where a unit's ids end. Between others stands a mark that the library knows as a token of its own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from meterline.llm.words import byte_runs, mix

END_ID = 0
#: What a worker's units and their ids may hold in memory; beyond it the worker starts anew.
CACHE_BYTES = 256 << 20
#: Longer units, such as lines without spaces, are encoded each time.
LONGEST_KEPT = 256
#: Bytes of a unit's entry besides its text and ids.
_ENTRY = 160
_LEARN_UNITS, _LEARN_BYTES, _RUN_BYTES = 4096, 1 << 18, 1 << 23
#: Units of a text that is joined from them; the library takes longer over each in longer texts.
_TEXT_UNITS = 256
# Characters that no text is meant to hold; a unit that does is encoded by itself. No end of the mark is also a beginning
# of it, so it is found between units wherever it stands.
_MARK = "\ue0ff\ue0fecut\ue0fd"


def _marked(*ranges: tuple[int, int]) -> np.ndarray:
    marks = np.zeros(256, bool)
    for low, high in ranges:
        marks[low : high + 1] = True
    return marks


# What a byte is, one bit for each class: first of a character that is never white space, whatever list of white space is
# used; any visible one of ASCII; a sign; a letter or digit; first of the Latin letters of two bytes, which also begins two
# signs; the space; the line end.
_NOT_SPACE, _VISIBLE, _SIGN, _ALNUM, _LATIN, _SPACE, _LINE_END = (1 << k for k in range(7))
_CLASSES = sum(
    bit * _marked(*ranges).astype(np.uint8)
    for bit, ranges in (
        (_NOT_SPACE, ((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xEE), (0xF0, 0xF4))),
        (_VISIBLE, ((0x21, 0x7E),)),
        (_SIGN, ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))),
        (_ALNUM, ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))),
        (_LATIN, ((0xC3, 0xC8),)),
        (_SPACE, ((0x20, 0x20),)),
        (_LINE_END, ((0x0A, 0x0A),)),
    )
).astype(np.uint8)
_CLASS_OF = _CLASSES.tobytes()

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def unit_starts(data: np.ndarray, doc_bytes: np.ndarray) -> np.ndarray:
    """Where the units begin, each document's first included."""
    at = np.zeros(len(data), bool)
    at[doc_bytes[:-1][np.diff(doc_bytes) > 0]] = True
    if len(data) > 1:
        kind = np.frombuffer(data.tobytes().translate(_CLASS_OF), np.uint8)
        followed = (kind[1:] & _NOT_SPACE).view(bool) & ~at[1:]  # by a non-space of the same document
        line_end = (kind[:-1] & _LINE_END != 0) & followed
        at[:-1] |= (kind[:-1] & _SPACE != 0) & followed
        at[1:-1] |= line_end[1:] & (kind[:-2] & _VISIBLE == 0)
        at[1:] |= line_end
        sign = np.flatnonzero(kind & _SIGN)
        sign = sign[sign > 1]
        last, before = data[sign - 1], data[sign - 2]
        other = (before == 0xC3) & ((last == 0x97) | (last == 0xB7))
        latin = (kind[sign - 2] & _LATIN != 0) & (last >= 0x80) & (last < 0xC0) & ~other
        at[sign[(kind[sign - 1] & _ALNUM != 0) | latin]] = True
    return np.flatnonzero(at)


def _parts(data: np.ndarray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64, copy=False)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)


def _taken(ids: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the numbers ``at``, one after the other, and the bytes of them that stand before each."""
    out = _parts(ids, bounds).take(pa.array(at))
    _, first, data = out.buffers()
    first = np.frombuffer(first, np.int64)[: len(at) + 1]
    return np.frombuffer(data or b"", np.uint32, first[-1] // 4), first


def _listed(units: pa.LargeBinaryArray, at: np.ndarray) -> list[bytes]:
    return units.take(pa.array(at)).to_numpy(zero_copy_only=False).tolist()


class ShortUnits:
    """Numbers of units of up to 16 bytes, kept in the order of a hash so that a whole run is looked up at once."""

    LONGEST = 16
    _LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def __init__(self) -> None:
        # Hash, last 8 bytes, number and size. With the last bytes and the size, the hash gives the first 8 bytes.
        self.rows = np.empty((3, 0), np.uint64)

    def _keys(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        head = eight[first] & self._LOW[np.minimum(sizes, 8)]
        tail = eight[first + 8] & self._LOW[np.maximum(sizes, 8) - 8]
        return mix(head + mix(tail + mix(sizes.astype(np.uint64)))), tail

    def find(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each unit, -1 where unknown, and what ``add`` takes: the rows of all units, without numbers."""
        hashes, tail = self._keys(data, first, sizes)
        order = np.argsort(hashes)
        rows = np.stack([hashes, tail, sizes.astype(np.uint64)])
        found = np.full(len(hashes), -1, np.int64)
        if self.rows.shape[1]:
            at = np.minimum(np.searchsorted(self.rows[0], hashes[order]), self.rows.shape[1] - 1)
            own, (known, end, number) = rows[:, order], self.rows[:, at]
            same = (known == own[0]) & (end == own[1]) & (number & np.uint64(31) == own[2])
            found[order[same]] = (number[same] >> np.uint64(5)).astype(np.int64)
        return found, rows

    def add(self, rows: np.ndarray, numbers: np.ndarray) -> None:
        rows = rows.copy()
        rows[2] |= numbers.astype(np.uint64) << np.uint64(5)
        rows = rows[:, np.argsort(rows[0])]
        self.rows = np.insert(self.rows, np.searchsorted(self.rows[0], rows[0]), rows, axis=1)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.add_tokens([AddedToken(_MARK, normalized=False)])
        self.mark = self.tokenizer.token_to_id(_MARK)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        # The file's ids stand for as many bytes as their names have characters.
        names = self.plain.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(self.mark + 1, np.int64)
        self.token_bytes[np.fromiter(names.values(), np.int64)] = np.fromiter(map(len, names), np.int64)
        self._clear()

    def _clear(self) -> None:
        self.short, self.known = ShortUnits(), dict[bytes, int]()  # longer ones
        self.count, self.held = 1, 0
        # Ids of all units, and the bytes of them that stand before each; the end id is number 0.
        self.ids, self.first = np.empty(1 << 16, np.uint32), np.zeros(1 << 12, np.int64)
        self.ids[0], self.first[1] = END_ID, 4

    def _apart(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any units, one after the other, and how many each has."""
        texts = [x.decode(errors="replace") for x in units]
        if any(_MARK in x for x in texts):
            found = [x.ids for x in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array(list(chain.from_iterable(found)), np.uint32), np.array([len(x) for x in found], np.int64)
        joined = self.tokenizer.encode_batch_fast([_MARK.join(texts)], add_special_tokens=False)[0].ids
        ids = np.array(joined, np.uint32)
        cut = np.flatnonzero(ids == self.mark)
        bounds = np.concatenate([[-1], cut, [len(ids)]])
        return np.delete(ids, cut), np.diff(bounds) - 1

    def _joined(self, units: list[bytes], lead: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that may stand one after the other, each after ``lead``, a character of one id or nothing."""
        try:
            texts = [(lead + lead.join(units[k : k + _TEXT_UNITS])).decode() for k in range(0, len(units), _TEXT_UNITS)]
        except UnicodeDecodeError:
            return self._apart(units)
        found = self.plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.uint32)
        ends = np.cumsum(self.token_bytes[ids])
        wanted = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + len(lead))
        to = np.searchsorted(ends, wanted) + 1
        low = np.concatenate([[0], to[:-1]])
        if to[-1] != len(ids) or (ends[to - 1] != wanted).any():
            return self._apart(units)
        if lead:
            if (self.token_bytes[ids[low]] != len(lead)).any():
                return self._apart(units)
            return np.delete(ids, low), to - low - 1
        return ids, to - low

    def _ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        kind = _CLASSES[np.frombuffer(b"".join(units), np.uint8)]
        to = np.cumsum(sizes)
        low, long = to - sizes, sizes > 1
        begins = kind[low] & _NOT_SPACE != 0
        led = ~begins & long & (kind[low] & _SPACE != 0) & (kind[np.minimum(low + 1, to - 1)] & _NOT_SPACE != 0)
        # In text that is not broken, a last byte of no class after the first of a Latin letter is that letter's.
        latin = long & (kind[to - 1] == 0) & (kind[np.maximum(to - 2, low)] & _LATIN != 0)
        line = begins & ((kind[to - 1] & _VISIBLE != 0) | latin)
        found, order = [], []
        for which, encode in (
            (led, lambda x: self._joined(x, b"")),
            (line, lambda x: self._joined(x, b"\n")),
            (~led & ~line, self._apart),
        ):
            at = np.flatnonzero(which)
            if len(at):
                found.append(encode([units[i] for i in at.tolist()]))
                order.append(at)
        ids, counts = (np.concatenate(x) for x in zip(*found))
        if len(found) == 1:
            return ids, counts
        place = np.empty(len(units), np.int64)
        place[np.concatenate(order)] = np.arange(len(units))
        return _taken(ids, np.concatenate([[0], np.cumsum(counts) * 4]), place)[0], counts[place]

    def _append(self, units: list[bytes], at: int) -> None:
        """Encode units and keep their ids as numbers from ``at`` on."""
        low = 0
        while low < len(units):
            high, size = low, 0
            while high < len(units) and high - low < _LEARN_UNITS and size < _LEARN_BYTES:
                size += len(units[high])
                high += 1
            ids, sizes = self._ids(units[low:high])
            n, used = at + low, int(self.first[at + low]) // 4
            if n + len(sizes) + 1 > len(self.first):
                self.first = np.concatenate([self.first, np.zeros(max(len(self.first), len(sizes)), np.int64)])
            if used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty(max(len(self.ids), len(ids)), np.uint32)])
            self.ids[used : used + len(ids)] = ids
            self.first[n + 1 : n + 1 + len(sizes)] = 4 * (used + np.cumsum(sizes))
            low = high

    def _numbers(self, units: pa.LargeBinaryArray) -> np.ndarray:
        """Numbers of units that differ; unknown ones are encoded and kept, if not too long."""
        _, bounds, data = units.buffers()
        bounds = np.frombuffer(bounds, np.int64)[: len(units) + 1]
        data = np.frombuffer(data or b"", np.uint8)[: bounds[-1]]
        sizes = np.diff(bounds)
        short = sizes <= ShortUnits.LONGEST
        at_short, at_long = np.flatnonzero(short), np.flatnonzero(~short)
        found = np.empty(len(units), np.int64)
        found[at_short], rows = self.short.find(data, bounds[at_short], sizes[at_short])
        texts = _listed(units, at_long)
        found[at_long] = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(found < 0)
        if len(new):
            # An id stands for one byte at least.
            held = np.where(sizes[new] > LONGEST_KEPT, 0, 5 * sizes[new] + _ENTRY)
            if self.held + held.sum() > CACHE_BYTES and self.count > 1:
                self._clear()
                return self._numbers(units)
            # With nothing known, only as many are kept as may be.
            held = np.cumsum(held)
            keep = (sizes[new] <= LONGEST_KEPT) & (self.held + held <= CACHE_BYTES)
            kept, passing = new[keep], new[~keep]
            at = self.count
            self._append(_listed(units, kept), at)
            found[kept] = np.arange(at, at + len(kept))
            self.count += len(kept)
            self.held += int(held[keep][-1]) if len(kept) else 0
            self.short.add(rows[:, np.searchsorted(at_short, kept[short[kept]])], found[kept[short[kept]]])
            kept = kept[~short[kept]]
            self.known.update(zip(_listed(units, kept), found[kept].tolist()))
            # The numbers of the others are those of the next units, too.
            self._append(_listed(units, passing), self.count)
            found[passing] = np.arange(self.count, self.count + len(passing))
        return found

    def encode(self, data: np.ndarray, doc_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents, each with the end id, one after the other, and where each begins."""
        starts = unit_starts(data, doc_bytes)
        units = _parts(data, np.append(starts, len(data))).dictionary_encode()
        numbers = self._numbers(units.dictionary)
        ends = np.searchsorted(starts, doc_bytes)
        at = np.insert(numbers[units.indices.to_numpy()], ends[1:], 0)
        out, first = _taken(self.ids, self.first[: numbers.max(initial=0) + 2], at)
        return out, first[ends + np.arange(len(ends))] // 4


def encoded(batch: pa.RecordBatch, column: str, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The binary column in runs of rows: first row, last row + 1, their ids, where each row's ids begin."""
    for at, to, data, doc_bytes in byte_runs(batch, column, _RUN_BYTES):
        yield at, to, *encoder(path).encode(data, doc_bytes)
