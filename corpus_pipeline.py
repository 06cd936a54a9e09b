"""From raw documents to packed training sequences, stage by stage; each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import lines, minhash, mixing, packing, quality, queries
from meterline.llm.storage import stored

# Documents that share so much of their runs of five words count as one; bands that miss such a pair with 8e-8.
NEAR_PERCENT, NEAR_BANDS, NEAR_ROWS = 80, 31, 4
# Of the words that are left, with no document twice.
MIX_PERCENT, MIX_EPOCHS = 80, 1
WEIGHTS = {"web": 5, "books": 3, "forums": 2, "web/en": 6, "books/en": 6}


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand elsewhere; their lengths are those of what is left."""
    kept = lines.without_repeated_chunks(docs, extend=True)
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
    types = dict(docs.dtypes)
    return kept.select(*(new[c].cast(types[c]).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_near_duplicates(docs, NEAR_PERCENT, NEAR_BANDS, NEAR_ROWS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each source as many documents as its budget holds."""
    return mixing.mixed(docs, queries.levels(), WEIGHTS, MIX_PERCENT, MIX_EPOCHS).select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of several context sizes."""
    return packing.pack(docs, queries.TOKENIZER)


STAGES = [
    ("quality rules", good_quality),
    ("line dedup", unique_lines),
    ("near duplicates", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

# Sketches, learned tokens and packing are not expressible in SQL; the tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), "stage")
    return rows
