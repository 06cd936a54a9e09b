"""Shards under a byte limit by extendible hashing.

The directory maps prefixes of a hash of the id to shards. It begins with one shard; a shard over the
limit, and no other, is split on one more bit, until all fit. A document's shard is therefore the
shortest prefix of its hash whose documents fit the limit together.

The work goes ``_BITS`` bits at a time: sizes by prefix are summed (per task first, then by shuffle), which
decides the splits on these bits; only rows of shards that are still too large go on to further bits. A
bucket is never gathered in one place. Ids that repeat share all bits of their hash; when these are used
up, their rows go on by a hash of the row's number, so a single id can fill several shards.

A text counts its bytes of UTF-8; null texts count none. A single text over the limit has a shard of its
own, marked by ``shard_bytes`` over the limit. Rows without id are placed by a hash of their text. With nothing
in them, tables give no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

SHARD_BYTES = 256 << 20
_BITS, _HASH_BITS = 10, 60


def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: int | Column) -> Column:
    """The first bits of the hash, as text of 0 and 1."""
    return F.substring("bits", F.lit(1), F.lit(bits) if isinstance(bits, int) else bits)


def assigned(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, bytes, shard (hash prefix), shard_bytes of each row, and its unit (id as text, or a hash)."""
    return _assigned(docs.select(*_unit(), F.monotonically_increasing_id().alias("number")), limit).drop("number")


def _unit() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    unit = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(text)))
    size = F.octet_length(text).cast("long")
    return [F.col("doc_id").cast("long").alias("doc_id"), unit.alias("unit"), size.alias("bytes")]


def _assigned(rows: DataFrame, limit: int) -> DataFrame:
    """The shard of each of the rows (doc_id, unit, bytes, number); rows of one unit are told apart by their number."""

    def bits(value: Column) -> Column:
        return F.lpad(F.bin(value), _HASH_BITS, "0")

    # Written once, so that the rows' numbers stay what they are.
    by_number = _hash60(F.col("number").cast("string"))
    open_ = stored(rows.withColumn("bits", F.concat(bits(_hash60(F.col("unit"))), bits(by_number))), "rows")
    done, depth = [], 0
    while True:
        to = min(depth + _BITS, 2 * _HASH_BITS)
        first = 0 if depth == 0 else depth + 1
        fine = open_.groupBy(_prefix(to).alias("bits")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("largest")
        )
        sizes = fine.select("bits", "bytes", "rows", F.explode(F.sequence(F.lit(first), F.lit(to))).alias("depth"))
        sizes = sizes.groupBy("depth", _prefix(F.col("depth")).alias("shard")).agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows")
        )
        fits = (F.col("shard_bytes") <= F.lit(limit)) | (F.col("rows") == 1) | (F.col("depth") == 2 * _HASH_BITS)
        # The shortest prefix that fits, for each of the fine ones.
        places = fine.select("bits", F.explode(F.sequence(F.lit(first), F.lit(to))).alias("depth"))
        places = places.withColumn("shard", _prefix(F.col("depth"))).join(sizes.where(fits), ["depth", "shard"])
        places = places.groupBy("bits").agg(F.min("depth").alias("depth"))
        places = places.withColumn("shard", _prefix(F.col("depth"))).join(sizes, ["depth", "shard"])
        places = places.select(F.col("bits").alias("fine"), "shard", "shard_bytes")
        placed = stored(
            open_.withColumn("fine", _prefix(to)).join(places, "fine", "left").drop("fine"), "placed"
        )
        done.append(placed.where("shard IS NOT NULL").select("doc_id", "bytes", "shard", "shard_bytes", "unit", "number"))
        open_, depth = placed.where("shard IS NULL").drop("shard", "shard_bytes"), to
        if depth == 2 * _HASH_BITS or open_.isEmpty():
            out = done[0]
            for more in done[1:]:
                out = out.unionByName(more)
            return out


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> str:
    """All columns of the documents, in a folder for each shard as ``assigned``; the name of the folders' column.

    That is ``shard``, with as many underscores behind it as tell it from the documents' own columns. Its values are the
    hash prefixes behind an s, as readers take bare digits for numbers.
    """
    name = "shard"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    # Stored with their numbers, each row goes to the shard that its own bytes were counted for.
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n")), "numbered")
    units = rows.select("row.doc_id", "row.text", "n")
    shards = _assigned(units.select(*_unit(), F.col("n").alias("number")), limit)
    shards = stored(shards.select("number", F.col("shard").alias("to")), "shards")
    out = rows.join(shards, F.col("n") == F.col("number")).select("row.*", F.concat(F.lit("s"), "to").alias(name))
    out.repartition(name).write.partitionBy(name).parquet(path)
    return name


def oracle_sql(limit: int, bits: int = 24) -> str:
    """The same shards while ``bits`` suffice."""
    return f"""
WITH rows AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
    lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), {_HASH_BITS}, '0') AS bits
  FROM documents
), sizes AS (
  SELECT depth, substr(bits, 1, depth) AS shard, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS n
  FROM rows, (SELECT unnest(range(0, {bits + 1})) AS depth) GROUP BY ALL
), fits AS (
  SELECT r.doc_id, r.bytes, s.shard, s.shard_bytes, s.depth FROM rows r JOIN sizes s
  ON substr(r.bits, 1, s.depth) = s.shard AND (s.shard_bytes <= {limit} OR s.n = 1)
)
SELECT doc_id, bytes, shard, shard_bytes FROM fits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""
