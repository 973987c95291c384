"""A corpus pipeline of five stages over documents: quality, exact copies, near copies, repeated strings, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and
returns the columns of documents; the last returns the packed pieces. Between stages the
rows are written as Parquet into the cluster's shared folder and read again.

Defined results: null and empty texts go through as the stages' operators say (the quality
stage scores them like any text; copies of them are one text; nothing repeats in them; each
is packed as its end id alone); rows with null ids are kept apart from all others by the
near-copy stage; of repeated rows one stays; extra columns are passed on up to the packing,
whatever their names; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenewright.llm import common, exact_dedup, near_dedup, packing, quality, repeats


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    score = common.unused(docs, "__score")
    scored = quality.scored(docs, quality.learned(docs, common.labels(spark, sf_dir)), score_col=score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).select(common.columns_of(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of equal texts, the one with the largest id."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies by strings of five words, the one with the smallest id."""
    return near_dedup.keep_one_of_each(docs, words=5)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out strings of 400 bytes and more that occur elsewhere; n_chars follows the text."""
    kept = repeats.remove_repeats(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(common.columns_of(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token windows."""
    return packing.pack_documents(docs)


STAGES = [("quality", good_quality), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("suffix_dedup", repeated_strings), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        with common.scratch(spark):  # what a stage wrote on its way goes with it
            docs = common.saved(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
