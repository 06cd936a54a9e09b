"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    codebooks,
    licences,
    lines,
    minhash,
    mixing,
    negatives,
    neighbours,
    packing,
    private,
    quality,
    sharding,
    substrings,
    tokenfiles,
)
from meterline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The tree that documents are mixed by: domains of sources, languages, sources.
DOMAINS = ("web", "books", "forums")
WEIGHTS = {"web": 5, "books": 3, "forums": 2, "web/en": 6, "web/de": 2, "books/en": 6, "forums/es": 0}
MIX_PERCENT, MIX_EPOCHS = 100, 2
SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def domain(source: str = "source") -> Column:
    """Domain of a source, by the number in its name."""
    number = F.expr(f"try_cast(regexp_extract({source}, '[0-9]+', 0) AS INT)")
    out = F.when(number % 3 == 0, DOMAINS[0]).when(number % 3 == 1, DOMAINS[1])
    return out.otherwise(DOMAINS[2])


def levels() -> dict[str, Column]:
    return {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, epoch of each copy taken."""
    mixed = mixing.mixed(_documents(spark, sf_dir), levels(), WEIGHTS, MIX_PERCENT, MIX_EPOCHS)
    return mixed.select("row.doc_id", "row.source", "row.lang", "epoch")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(_documents(spark, sf_dir), path, TOKENIZER)
    return tokenfiles.read_documents(spark, path)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), TOKENIZER)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256."""
    kept = lines.without_repeated_chunks(_documents(spark, sf_dir))
    return kept.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def licence_path() -> Column:
    """A place for each document: a folder for each source, in it one for each language.

    One id in 500 is the licence file of the language's folder, one that of the source's.
    """
    folder = F.concat_ws("/", "source", F.when(F.col("doc_id") % 500 != 1, F.col("lang")))
    name = F.concat(F.expr("doc_id div 1000").cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return F.concat_ws("/", folder, F.when(F.col("doc_id") % 500 < 2, F.lit("LICENSE")).otherwise(name))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, path, licence, score, found."""
    files = _documents(spark, sf_dir).select("doc_id", licence_path().alias("path"), "text")
    return licences.scan(files).select("row.doc_id", "row.path", "licence", "score", "found")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(_documents(spark, sf_dir)).drop("kept_text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, bytes, shard, shard_bytes."""
    return sharding.assigned(_documents(spark, sf_dir), SHARD_BYTES).drop("unit")


def op11_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows, _ = private.spans_and_models(_documents(spark, sf_dir), F.col("doc_id"))
    return private.digests(rows).select("row.doc_id", *(f"n_{k}" for k in private.KINDS), "base_sha256", "spans")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    coded, books = codebooks.compressed(_table(spark, sf_dir, "embeddings"))
    rows = codebooks.with_label_errors(coded).select("vec_id", "code", "error", "label_error")
    return rows.withColumn("codebooks_sha256", F.lit(codebooks.digest(books)))


def relabelled() -> Column:
    """The label that negatives are mined by: that of every seventh row is another one."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), relabelled())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    operators = (
        op1_minhash, op2_neighbours, op3_mixing, op4_token_files, op5_packing,
        op6_lines, op7_licences, op8_substrings, op9_quality, op10_sharding,
        op11_private, op12_vector_codes, op13_hard_negatives,
    )
    return {f.__name__: f for f in operators} | {"pipeline": pipeline}


def _divide(name: str, above: str, own: str, source: str, parent: str) -> str:
    """SQL of one level of the budget: nodes of ``source`` under the nodes of ``parent``."""
    keys = f"PARTITION BY {above}" if above else ""
    join = f"JOIN {parent} p USING ({above})" if above else f"CROSS JOIN {parent} p"
    weights = " ".join(f"WHEN path = '{k}' THEN {v}" for k, v in WEIGHTS.items())
    every = f"{above}, {own}" if above else own
    path = f"concat_ws('/', {every})"
    return f"""
{name}_0 AS (SELECT {every}, {path} AS path, CAST(sum(cap) AS BIGINT) AS cap FROM {source} GROUP BY ALL),
{name}_1 AS (SELECT n.*, p.amount, CASE {weights} ELSE 1 END AS weight FROM {name}_0 n {join}),
{name}_2 AS (SELECT *, cap / weight AS ratio,
  coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM {name}_1 WHERE weight > 0 WINDOW o AS ({keys} ORDER BY cap / weight, path)),
{name}_3 AS (SELECT *, CAST(amount - before AS DOUBLE) / weights AS level FROM {name}_2),
{name}_4 AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER ({keys}) AS fits FROM {name}_3),
{name} AS (SELECT {every}, CASE WHEN fits IS NULL THEN cap
  ELSE greatest(CAST(floor(least(CAST(cap AS DOUBLE), fits * weight)) AS BIGINT), 0) END AS amount FROM {name}_4)"""


def _mixing_sql() -> str:
    shut = ", ".join(f"'{path}'" for path, weight in WEIGHTS.items() if weight == 0)
    # What stands below a node of weight 0 counts in no cap above it.
    closed = f"d IN ({shut}) OR concat_ws('/', d, l) IN ({shut}) OR concat_ws('/', d, l, s) IN ({shut})" if shut else "false"
    return rf"""
WITH units AS (
  SELECT doc_id, source, lang, source AS s, lang AS l,
    CASE CAST(regexp_extract(source, '[0-9]+') AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'forums' END AS d,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM documents
), leaves AS (
  SELECT d, l, s, CAST(sum(words) AS BIGINT) AS supply, CASE WHEN {closed} THEN 0 ELSE CAST(sum(words) * {MIX_EPOCHS} AS BIGINT) END AS cap
  FROM units GROUP BY ALL
), top AS (SELECT CAST(floor(sum(supply) * {MIX_PERCENT} / 100) AS BIGINT) AS amount FROM leaves),
{_divide("by_domain", "", "d", "leaves", "top")},
{_divide("by_lang", "d", "l", "leaves", "by_domain")},
{_divide("by_source", "d, l", "s", "leaves", "by_lang")},
parts AS (
  SELECT d, l, s, CASE WHEN supply > 0 THEN amount // supply ELSE 1 END AS whole,
    CASE WHEN supply > 0 THEN amount % supply ELSE 0 END AS rest
  FROM by_source JOIN leaves USING (d, l, s)
), ordered AS (
  SELECT u.*, whole, rest, coalesce(sum(words) OVER (PARTITION BY d, l, s
    ORDER BY CAST('0x' || substr(md5('{mixing.SEED}|' || (whole + 1) || '|' || doc_id), 1, 15) AS BIGINT), CAST(doc_id AS VARCHAR)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM units u JOIN parts USING (d, l, s)
)
SELECT doc_id, source, lang, CAST(unnest(range(1, whole + CASE WHEN ahead < rest THEN 2 ELSE 1 END)) AS BIGINT) AS epoch FROM ordered
"""


_SUBSTRINGS_SQL = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - {substrings.MIN_WORDS - 2})) AS i, w FROM docs WHERE len(w) >= {substrings.MIN_WORDS}
), keyed AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + {substrings.MIN_WORDS - 1}], ' ')) AS k FROM windows
), repeated AS (
  SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY k) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM repeated, (SELECT unnest(range(0, {substrings.MIN_WORDS})) AS j)
), words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM docs
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


def all_sql() -> dict[str, str]:
    """SQL over whole tables; the others are tested against brute force, round trips or held-out rows."""
    return {
        "op3_mixing": _mixing_sql(),
        "op6_lines": lines.ORACLE_SQL,
        "op8_substrings": _SUBSTRINGS_SQL,
        "op10_sharding": sharding.oracle_sql(SHARD_BYTES),
        "op12_vector_codes": codebooks.oracle_sql(),
        "op13_hard_negatives": negatives.oracle_sql(),
    }
