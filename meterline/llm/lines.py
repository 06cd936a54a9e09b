"""Removal of multi-line chunks that occur in several places, with content-defined boundaries.

A text is cut after each line at which a rolling hash of the last ``WINDOW`` line hashes is divisible by
``DIVISOR``, and at its end. Boundaries depend on the lines around them alone, so a passage that
stands further down in another document is cut in the same places. Chunks of ``MIN_LINES`` lines or
more that are not blank are grouped by their bytes over all documents; one of each group stays: the first in
the document with the smallest id. The others are removed.

With ``extend``, a removed chunk is a seed: it takes along the lines before and after it that equal, one by one, those
around the place that stays, one-line chunks included, until lines differ. The lines compared reach over the
next chunk that could repeat; if that is equal as a whole, it is a seed itself, unless the lines above a passage
cut its first ``WINDOW - 1`` lines differently, so as many more lines are compared on that side.
Every line that goes stands in the same place of a passage in an earlier document, or further up in its own.

Only DataFrame functions are used. Groups are counted per task before the shuffle; where the copies
stand is found by a join on 128 bits of hash of two written tables, which adaptive execution splits where a chunk stands
in very many documents. A row's removed chunks meet in one row, as its text does.

Defined cases: a null text stays null and has no lines; an empty one has one empty line. Rows without id come
last: their chunks go if a document with an id has them too, and stay otherwise. Rows that repeat an
id and text are one document. Other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

WINDOW, DIVISOR, MIN_LINES = 3, 3, 2
_BASE = 31
_NOT_BLANK = r"[^\x20\x09-\x0D]"


def _line_hash(line: Column) -> Column:
    """28 bits, so that the rolling sum stays far from the limits of a long."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _with_spans(rows: DataFrame) -> DataFrame:
    """Adds ``lines`` and ``spans``: array of (s, e), first line and last line + 1 of each chunk."""
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn("hashes", F.transform("lines", _line_hash))
    # Line i beside the lines before it: the same array, moved by one, two, ... places.
    moved = [F.col("hashes").alias("h0")]
    for k in range(1, WINDOW):
        moved.append(F.concat(F.array_repeat(F.lit(0).cast("long"), k), F.col("hashes")).alias(f"h{k}"))
    rows = rows.withColumn("near", F.slice(F.arrays_zip(*moved), F.lit(1), F.size("lines")))

    def rolled(x: Column) -> Column:
        total = x["h0"]
        for k in range(1, WINDOW):
            total = total + x[f"h{k}"] * F.lit(_BASE**k)
        return total

    last = F.size("near")
    ends = F.filter(
        F.transform("near", lambda x, i: F.when(rolled(x) % F.lit(DIVISOR) == 0, i + 1)), lambda e: e.isNotNull()
    )
    rows = rows.withColumn("ends", F.array_union(ends, F.array(last)))
    starts = F.concat(F.array(F.lit(0)), F.col("ends"))
    rows = rows.withColumn("spans", F.slice(F.arrays_zip(starts.alias("s"), F.col("ends").alias("e")), F.lit(1), F.size("ends")))
    return rows.drop("hashes", "near", "ends")


def with_chunks(rows: DataFrame) -> DataFrame:
    """Adds ``chunks``: array of (lines, text) that joined by line ends give the column ``text`` again."""
    rows = _with_spans(rows)
    chunk = F.transform(
        "spans",
        lambda p: F.struct(
            (p["e"] - p["s"]).alias("lines"), F.array_join(F.slice("lines", p["s"] + 1, p["e"] - p["s"]), "\n").alias("text")
        ),
    )
    return rows.withColumn("chunks", chunk).drop("spans")


def _with_surroundings(rows: DataFrame) -> DataFrame:
    """Chunks with ``before`` and ``after``, from the chunk outwards: hashes of the lines as far as they are compared."""
    rows = _with_spans(rows).withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))

    def could_repeat(p: Column) -> Column:
        own = F.slice("lines", p["s"] + 1, p["e"] - p["s"])
        return (p["e"] - p["s"] >= MIN_LINES) & F.exists(own, lambda x: x.rlike(_NOT_BLANK))

    def bounds(spans: Column, end: Column, of: str) -> Column:
        # For each chunk the outer bound of the last chunk before it that could repeat, in the order of ``spans``.
        start = F.struct(F.array().cast("array<int>").alias("all"), end.cast("int").alias("last"))
        step = F.aggregate(
            spans, start,
            lambda a, p: F.struct(
                F.concat(a["all"], F.array(a["last"])).alias("all"),
                F.when(could_repeat(p), p[of]).otherwise(a["last"]).alias("last"),
            ),
        )
        return step["all"]

    froms = bounds(F.col("spans"), F.lit(0), "s")
    rows = rows.withColumn("froms", F.transform(froms, lambda i: F.greatest(i - (WINDOW - 1), F.lit(0))))
    rows = rows.withColumn("tos", F.reverse(bounds(F.reverse("spans"), F.size("lines"), "e")))
    chunk = F.transform(
        F.arrays_zip("spans", "froms", "tos"),
        lambda c: F.struct(
            (c["spans"]["e"] - c["spans"]["s"]).alias("lines"),
            F.array_join(F.slice("lines", c["spans"]["s"] + 1, c["spans"]["e"] - c["spans"]["s"]), "\n").alias("text"),
            F.reverse(F.slice("hashes", c["froms"] + 1, c["spans"]["s"] - c["froms"])).alias("before"),
            F.slice("hashes", c["spans"]["e"] + 1, c["tos"] - c["spans"]["e"]).alias("after"),
        ),
    )
    return rows.withColumn("chunks", chunk)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )


def _keys(text: Column) -> tuple[Column, Column]:
    # The constant comes first: it then seeds the text's hash, and neither key follows from the other.
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")


def _agreeing(a: str, b: str) -> Column:
    """How many elements the arrays share from their start."""
    same = F.transform(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda x: x["a"].eqNullSafe(x["b"]))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def repeated_chunks(docs: DataFrame, extend: bool = False) -> DataFrame:
    """doc_id, text_hash, gone: the chunks of each document to be removed.

    Each with its number (from 0) and, unless ``extend`` is false, the lines before and after it that go with it.
    """
    around = ["before", "after"] if extend else []
    chunks = (_with_surroundings if extend else with_chunks)(_rows(docs).where("text IS NOT NULL"))
    chunks = chunks.select("doc_id", "text_hash", F.posexplode_outer("chunks"))
    chunks = chunks.where((F.col("col.lines") >= MIN_LINES) & F.col("col.text").rlike(_NOT_BLANK))
    chunks = chunks.select(
        "doc_id", "text_hash", F.col("pos").alias("chunk"), F.col("col.text").alias("text"), *(f"col.{c}" for c in around)
    )
    groups = chunks.groupBy("text").agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("first_doc"))
    groups = groups.where("times > 1").select(*_keys(F.col("text")), "first_doc")
    # Stored, with plain tables on both sides of the join: nothing above it needs the places of a chunk together.
    groups = stored(groups, "groups")
    places = stored(chunks.select("doc_id", "text_hash", "chunk", *_keys(F.col("text")), *around).join(groups, ["k1", "k2"]), "places")
    # In the document that comes first, the first of its places stays; one row of each task and chunk is shuffled.
    own = ["doc_id", "text_hash", "k1", "k2"]
    firsts = places.where(F.col("doc_id").eqNullSafe(F.col("first_doc"))).groupBy(*own).agg(F.min("chunk").alias("chunk"))
    firsts = stored(firsts, "firsts").select(*(F.col(c).alias(f"f_{c}") for c in (*own, "chunk")))
    same = F.lit(True)
    for c in (*own, "chunk"):
        same = same & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    if not extend:
        gone = places.select(*own, "chunk").join(firsts, same, "left_anti").select("doc_id", "text_hash", "chunk")
        return stored(gone, "gone_chunks").groupBy("doc_id", "text_hash").agg(F.collect_set("chunk").alias("gone"))
    stays = F.col("f_k1").isNotNull().alias("stays")
    places = stored(places.join(firsts, same, "left").select(*own, "chunk", *around, stays), "places")
    first = places.where("stays").groupBy("k1", "k2").agg(F.min(F.struct("text_hash", "chunk", *around)).alias("f"))
    first = first.select("k1", "k2", F.col("f.before").alias("f_before"), F.col("f.after").alias("f_after"))
    gone = places.where("NOT stays").join(first.hint("merge"), ["k1", "k2"]).select(
        "doc_id", "text_hash",
        F.struct("chunk", _agreeing("before", "f_before").alias("before"), _agreeing("after", "f_after").alias("after")).alias("g"),
    )
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("g").alias("gone"))


def without_repeated_chunks(docs: DataFrame, extend: bool = False) -> DataFrame:
    """row (all columns as they came), n_lines, n_removed (lines), kept_text for each row."""
    gone = stored(repeated_chunks(docs, extend), "gone")
    whole = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    joined = whole.join(
        # Texts are large at any size of the other side, so both sides are shuffled however small it is.
        gone.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "gone").hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash")),
        "left",
    ).select("row", F.col("row.text").cast("string").alias("text"), "gone")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)
    same = joined.where("gone IS NULL").select(
        "row", n_lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept_text")
    )
    if extend:
        cut = _with_spans(joined.where("gone IS NOT NULL"))
        span = lambda g: F.get("spans", g["chunk"])
        removed = F.transform("gone", lambda g: F.sequence(span(g)["s"] - g["before"], span(g)["e"] + g["after"] - 1))
        kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.flatten(removed))
        cut = cut.withColumn("kept", kept).select(
            "row", F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
            F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n").alias("kept_text"),
        )
        return same.unionByName(cut)
    cut = with_chunks(joined.where("gone IS NOT NULL"))
    cut = cut.withColumn("kept", F.filter("chunks", lambda c, i: ~F.array_contains("gone", i)))
    left = F.aggregate("kept", F.lit(0).cast("long"), lambda n, c: n + c["lines"])
    cut = cut.select(
        "row", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - left).alias("n_removed"),
        F.array_join(F.transform("kept", lambda c: c["text"]), "\n").alias("kept_text"),
    )
    return same.unionByName(cut)


ORACLE_SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, len(l) AS n, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM lines
), rolled AS (
  SELECT doc_id, i, n, line, h
    + {_BASE} * coalesce(lag(h, 1) OVER w, 0) + {_BASE * _BASE} * coalesce(lag(h, 2) OVER w, 0) AS r
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(CASE WHEN r % {DIVISOR} = 0 THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM rolled
), chunks AS (
  SELECT doc_id, chunk, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS text FROM numbered GROUP BY ALL
), groups AS (
  SELECT text, min(doc_id) AS first_doc FROM chunks
  WHERE lines >= {MIN_LINES} AND regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY text HAVING count(*) > 1
), judged AS (
  SELECT c.*, g.text IS NOT NULL AND NOT (c.doc_id = g.first_doc
    AND row_number() OVER (PARTITION BY c.doc_id, c.text ORDER BY c.chunk) = 1) AS gone
  FROM chunks c LEFT JOIN groups g ON c.text = g.text AND c.lines >= {MIN_LINES}
)
SELECT doc_id, CAST(sum(lines) AS BIGINT) AS n_lines,
  CAST(sum(CASE WHEN gone THEN lines ELSE 0 END) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(text, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
