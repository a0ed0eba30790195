"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; `run` writes it as Parquet in the shared folder and the next
stage reads it from there, so a lost executor never costs more than one stage.

Rows that repeat both id and text are one document; the second stage keeps one of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import common, exact_dedup, near_dedup, packing, quality, substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _only_these(docs: DataFrame, keep: DataFrame, text_hash) -> DataFrame:
    """The rows of `docs` whose (doc_id, hash of the text) `keep` holds. Both sides are
    shuffled as they are, so that adaptive execution can split a frequent key."""
    named = docs.withColumn("_hash", text_hash)
    wanted = keep.toDF("_id", "_kept_hash")
    return named.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_kept_hash")), "left_semi").drop("_hash")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score >= 0.3)."""
    docs = common.only(docs, *COLUMNS)
    model = quality.fit_on_sample(docs, common.table(spark, sf_dir, "labels"), "quality")
    return quality.classify(docs, model).filter("predicted = 1").select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (equal up to the case of A-Z): the one with the largest id."""
    docs = common.only(docs, *COLUMNS)
    decided = exact_dedup.exact_dedup(docs, keep="largest").filter("kept")
    keep = decided.select("doc_id", "text_sha256").distinct()
    normal = F.sha2(exact_dedup.ascii_lower(common.text_or_empty()), 256)
    # Repeated rows: one per id and normalised text, pre-aggregated before any shuffle.
    others = [c for c in COLUMNS if c != "doc_id"]
    single = decided.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = _only_these(docs, keep, normal)
    if single.isEmpty():
        return kept.select(*COLUMNS)
    once = (kept.withColumn("_norm", normal).groupBy("doc_id", "_norm")
            .agg(F.max(F.struct(*others)).alias("row")).select("doc_id", "row.*"))
    return once.select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5 words, similarity 0.8): the smallest id."""
    docs = common.only(docs, *COLUMNS)
    keep = near_dedup.near_dedup(docs).filter("stays").select("doc_id", "text_hash").distinct()
    return _only_these(docs, keep, F.xxhash64(common.text_or_empty())).select(*COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that a window of 35 words covers which also starts elsewhere.
    A text that loses nothing stays as it is; n_chars follows the text."""
    carried = docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text")
    cut = substring_dedup.substring_dedup(carried, id_col="row", whole_as_is=True)
    return cut.select("row.*", F.col("kept").alias("text")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]

#: Several stages (votes of a trained model, components) have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
