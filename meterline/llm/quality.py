"""Quality rules: base counts, and how far a document's make-up is from that of its language.

For each language the corpus gives two reference distributions, taken over all its documents: of
character classes, and of the ``COMMON`` most frequent words (and all others together). A document
is compared with both by the Jensen-Shannon distance (base 2: 0 for equal, 1 for disjoint
distributions). It fails if one distance is over its limit, or if the base rules fail.

Guards: a document of fewer than ``MIN_WORDS`` words fails the base rule and is not compared; as a
short text strays from any reference by chance alone, each limit grows with its slack / sqrt(n_words).
Every language has a reference, however many languages there are and however few documents one has: references are a
table of a row each, joined to the documents by language. A document that is much of its language's text is near its
reference by construction and passes.

Defined cases: null and empty texts have no words and fail the base rule. A null language is one of
its own. Repeated rows are judged each by itself; ties among common words go to the smaller hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import mapped, stored
from meterline.llm.words import Words, chunks, mix, roll, signed

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COMMON = 64
CHAR_LIMIT, CHAR_SLACK = 0.24, 0.5
WORD_LIMIT, WORD_SLACK = 0.3, 1.8
_ROWS = 200_000
# A run's arrays take a hundred times its bytes; all stages share the memory of a Python worker.
_CHUNK = 1 << 19

# Character classes by the first byte of a character; the bytes that follow it have none.
_CLASSES = 8
_CLASS = np.full(256, 7, np.int64)  # other ASCII
_CLASS[0x80:0xC0] = -1
_CLASS[0xC0:] = 6  # beyond ASCII
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_CLASS[_SYMBOLS] = 5


def _class_counts(words: Words) -> np.ndarray:
    """Documents x classes."""
    n = len(words.counts)
    kind = _CLASS[words.data]
    doc = np.repeat(np.arange(n), np.diff(words.doc_bytes))
    seen = kind >= 0
    return np.bincount(doc[seen] * _CLASSES + kind[seen], minlength=n * _CLASSES).reshape(n, _CLASSES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 1) and character classes (kind 0) by language, summed over a good many documents."""
    kept: dict[tuple, list] = {}
    rows = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, kind), parts in kept.items():
            key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([p[1] for p in parts]).astype(float)).astype(np.int64)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(key), pa.string()),
                    "kind": pa.array(np.full(len(key), kind), pa.int32()),
                    "key": signed(key),
                    "n": n,
                }
            )
        kept.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for low, high, words in chunks(batch, "body", _CHUNK):
            classes, hashes, doc = _class_counts(words), words.hashes(), words.doc_of_word()
            code = {x: i for i, x in enumerate(dict.fromkeys(langs[low:high]))}
            own = np.array([code[x] for x in langs[low:high]])
            for lang, i in code.items():
                mine = own == i
                key, n = np.unique(hashes[mine[doc]], return_counts=True)
                kept.setdefault((lang, 1), []).append((key, n))
                kept.setdefault((lang, 0), []).append((np.arange(_CLASSES, dtype=np.uint64), classes[mine].sum(0)))
                rows += len(key)
            if rows > 10 * _ROWS:
                yield from out()
                rows = 0
    yield from out()


def _body(docs: DataFrame, *columns: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(*columns, F.col("lang").cast("string").alias("lang"), text.alias("body"))


_REFERENCE = ["chars", "words", "shares"]


def references(docs: DataFrame) -> DataFrame:
    """ref_lang, chars (shares of the character classes), words (hashes of the common words) and their shares."""
    counts = mapped(_body(docs), _counted, "lang string, kind int, key long, n long")
    counts = counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    # The most frequent words by language; the window's limit is applied before its shuffle too.
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    top = counts.select("*", place.alias("place")).where(F.col("place") <= F.lit(COMMON))
    total = counts.where("kind = 1").groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("total"))
    listed = F.array_sort(F.collect_list(F.when(F.col("kind") == 1, F.struct("place", "key", "n"))))
    by_class = F.map_from_entries(F.collect_list(F.when(F.col("kind") == 0, F.struct("key", "n"))))
    rows = top.groupBy("lang").agg(listed.alias("common"), by_class.alias("classes"))
    rows = rows.join(total, F.col("lang").eqNullSafe(F.col("of")))
    classes = F.array(*(F.coalesce(F.element_at("classes", F.lit(i).cast("long")), F.lit(0)) for i in range(_CLASSES)))
    signs = F.greatest(F.aggregate("counted", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    rows = rows.select("lang", "common", "total", classes.alias("counted"))
    return rows.select(
        F.col("lang").alias("ref_lang"), F.transform("counted", lambda x: x / signs).alias("chars"),
        F.transform("common", lambda x: x["key"]).alias("words"), F.transform("common", lambda x: x["n"] / F.col("total")).alias("shares"),
    )


def _distances(
    words: Words, hashes: np.ndarray, classes: np.ndarray, mine: np.ndarray, reference: dict
) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the documents ``mine`` from the reference of their language."""
    common = np.array(reference["words"], np.int64).view(np.uint64)
    order = np.argsort(common)
    shares = np.zeros(COMMON + 1)
    shares[: len(common)] = reference["shares"]
    shares[COMMON] = 1 - shares[:COMMON].sum()
    doc = words.doc_of_word()
    own = mine[doc]
    number = np.cumsum(mine) - 1
    where = np.searchsorted(common[order], hashes[own])
    found = order[np.minimum(where, len(common) - 1)]
    slot = np.where(common[found] == hashes[own], found, COMMON)
    n = int(mine.sum())
    hist = np.bincount(number[doc[own]] * (COMMON + 1) + slot, minlength=n * (COMMON + 1)).reshape(n, COMMON + 1)
    chars = np.array(reference["chars"])[None]
    return divergence(_share(classes[mine]), chars), divergence(_share(hist), shares[None])


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` from that of ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = [np.where(x > 0, x * np.log2(x / m), 0).sum(1) for x in (p, q)]
    return np.sqrt(np.maximum(0, (part[0] + part[1]) / 2))


def _repeat_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words in 3-word windows that the document has twice or more."""
    at, key = words.windows(hashes, 3)
    doc = words.doc_of_word()
    key = mix(key + (doc[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _, group, times = np.unique(key, return_inverse=True, return_counts=True)
    step = np.zeros(len(hashes) + 1, np.int32)
    found = at[times[group] > 1]
    np.add.at(step, found, 1)
    np.add.at(step, found + 3, -1)
    return np.diff(np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])[words.first])


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _share(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def _judged(columns: list[str], text_of: str | None = None):
    """Verdicts beside ``columns``; the text is the column ``body``, or else the field ``text`` of the record ``text_of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if text_of:
                body = pc.struct_field(batch.column(text_of), "text").cast(pa.large_binary())
                batch = batch.append_column("body", body)
            langs = batch.column("lang").to_pylist()
            for low, high, words in chunks(batch, "body", _CHUNK):
                n, hashes, n_words = high - low, words.hashes(), words.counts
                classes = _class_counts(words)
                symbol = np.zeros(256, bool)
                symbol[_SYMBOLS] = True
                n_symbols = np.diff(np.concatenate([[0], np.cumsum(symbol[words.data])])[words.doc_bytes])
                repeats = _repeat_words(words, hashes)
                text = words.data.tobytes()
                dups = [_dup_lines(text[a:b]) for a, b in zip(words.doc_bytes, words.doc_bytes[1:])]
                base_failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
                chars, common = np.zeros(n), np.zeros(n)
                first = {x: i for i, x in reversed(list(enumerate(langs[low:high])))}
                code = {x: i for i, x in enumerate(first)}
                lang = np.array([code[x] for x in langs[low:high]])
                for x, i in code.items():
                    reference = {c: batch.column(c)[low + first[x]].as_py() for c in _REFERENCE}
                    if reference["words"]:  # a language without words has nothing to compare
                        mine = lang == i
                        chars[mine], common[mine] = _distances(words, hashes, classes, mine, reference)
                slack = 1 / np.sqrt(np.maximum(n_words, 1))
                kept = ~base_failed & (chars <= CHAR_LIMIT + CHAR_SLACK * slack) & (common <= WORD_LIMIT + WORD_SLACK * slack)
                yield pa.record_batch(
                    {
                        **{c: batch.column(c).slice(low, n) for c in columns},
                        "n_words": pa.array(n_words, pa.int64()),
                        "word_chars": pa.array(classes.sum(1) - classes[:, 3], pa.int64()),
                        "n_symbols": pa.array(n_symbols, pa.int64()),
                        "n_dup_lines": pa.array(dups, pa.int64()),
                        "n_repeat_words": pa.array(repeats, pa.int64()),
                        "base_failed": pa.array(base_failed, pa.bool_()),
                        "char_distance": pa.array(chars),
                        "word_distance": pa.array(common),
                        "kept": pa.array(kept, pa.bool_()),
                    }
                )

    return run


_RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "char_distance double, word_distance double, kept boolean"
)


def _with_references(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with the reference of their language."""
    return docs.join(known, F.col("lang").eqNullSafe(F.col("ref_lang")), "left").drop("ref_lang")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, both distances (0 where none was taken) and kept, for each row."""
    # A table, so that the join can be split by rows of a language that most documents have.
    known = stored(references(docs), "references")
    rows = _with_references(_body(docs, F.col("doc_id").cast("long").alias("doc_id")), known)
    return mapped(rows, _judged(["doc_id"]), f"doc_id long, {_RESULT}")


def good_documents(docs: DataFrame) -> DataFrame:
    """All columns of the rows that are kept."""
    known = stored(references(docs), "references")
    records = docs.select(F.struct("*").alias("row"), F.col("lang").cast("string").alias("lang"))
    kind = records.schema["row"].dataType.simpleString()
    # The text goes to Python once, inside its record.
    judged = mapped(_with_references(records, known), _judged(["row"], "row"), f"row {kind}, {_RESULT}")
    return judged.where("kept").select("row.*")
