"""Exact deduplication with a heavy-hitter split (operator 6).

Digests of normalised texts are summed up by a mergeable frequent-items summary of the
Misra-Gries family (`approx_top_k`, at most `tracked` counters whatever the input). The
few digests it proposes are counted exactly; their winners form a table of at most
`heavy` rows, which is broadcast so that copies of them are resolved on the map side and
never shuffled. All other digests are rarer than about 1/`tracked` of the rows each and
take an ordinary shuffle. Everything runs in built-in expressions.

Defined results: a null text counts as empty, and all empty texts are one group; of equal
texts the row with the largest id stays (a null id is smaller than any other); where whole
rows repeat, exactly one of them stays. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


def normalised(text: str = "text") -> Column:
    """The text with A-Z, and nothing else, lower-cased; null is empty."""
    return F.translate(common.text_or_empty(text), common.UPPER, common.LOWER)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", heavy: int = 256, tracked: int = 4096) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    base = common.saved(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "exact-digests",
    )
    # the summary counts 64-bit prefixes; what it proposes is only a hint, counted exactly below
    hint = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    proposed = base.select(hint.alias("hint")).agg(F.expr(f"approx_top_k(hint, {heavy}, {tracked})").alias("top")).select(F.explode("top.item").alias("hint"))
    winner = F.max(F.struct("doc_id", "rid")).alias("winner")
    winners = (
        base.withColumn("hint", hint).join(F.broadcast(proposed), "hint", "left_semi")
        .groupBy("digest").agg(winner, F.count(F.lit(1)).alias("group_size"))
        .orderBy(F.desc("group_size"), "digest").limit(heavy)
    )
    winners = common.saved(winners, "exact-winners")
    split = base.join(F.broadcast(winners), "digest", "left")
    frequent = split.filter(F.col("winner").isNotNull())
    others = split.filter(F.col("winner").isNull()).select("doc_id", "digest", "rid")
    # grouped first, so that a digest just below the winners' size is summed up in the map tasks
    rest = others.join(others.groupBy("digest").agg(winner, F.count(F.lit(1)).alias("group_size")), "digest").select("doc_id", "digest", "rid", "winner", "group_size")
    return frequent.select(rest.columns).unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever these are called."""
    sha, place, kept_id, kept_sha = (common.unused(docs, n) for n in ("__sha", "__n", "__kept_id", "__kept_sha"))
    found = exact_dedup(docs, id_col=id_col, text_col=text_col).filter("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    marked = docs.withColumn(sha, F.sha2(normalised(text_col), 256))
    kept = marked.join(found, marked[id_col].eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    again = Window.partitionBy(id_col, sha).orderBy(id_col)
    return kept.withColumn(place, F.row_number().over(again)).filter(F.col(place) == 1).select(common.columns_of(docs))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.documents(spark, sf_dir))


ORACLE = f"""
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""
