"""Full-text retrieval: documents of all layers, postings, BM25."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
#: Letters and what they are searched as.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def folded(c: Column) -> Column:
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def terms(c: Column) -> Column:
    """Lower-case terms without accents, split at everything that is no letter or digit."""
    return F.filter(F.split(folded(c), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def rag_documents(sources: dict[str, DataFrame]) -> DataFrame:
    """One table of all layers. Each source has document_id, source_id, title, text and may have parent_id, page_start, page_end, metadata."""
    out = None
    for kind, df in sources.items():
        have = set(df.columns)
        columns = {"parent_id": "string", "page_start": "int", "page_end": "int", "metadata": "string"}
        row = df.select(
            F.col("document_id").cast("string").alias("document_id"), F.lit(kind).alias("source_type"), F.col("source_id").cast("string").alias("source_id"), "title", "text",
            *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()],
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("rag_id", F.concat_ws(":", "document_id", "source_type", "source_id"))


def said(rag: DataFrame) -> Column:
    """The terms of title and text, in order."""
    return terms(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))))


def postings(rag: DataFrame, *, id_col: str = "rag_id", only: DataFrame | None = None) -> DataFrame:
    """(rag_id, term, tf) over title and text; of the terms of `only` alone, where given, so that nothing else is shuffled."""
    each = rag.select(id_col, F.explode(said(rag)).alias("term"))
    if only is not None:
        each = each.join(only.select("term").distinct(), "term", "left_semi")
    return each.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_stats(rag: DataFrame, *, id_col: str = "rag_id") -> DataFrame:
    """(rag_id, size): terms of each document that has any."""
    return rag.select(id_col, F.size(said(rag)).cast("long").alias("size")).filter("size > 0")


def asked_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term), each term of a query once."""
    return queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))


def phrase_matches(rag: DataFrame, queries: DataFrame, *, id_col: str = "rag_id") -> DataFrame:
    """(query_id, rag_id) whose text holds the query's terms next to each other, in order."""
    want = queries.select("query_id", terms(F.col("text")).alias("q")).filter(F.size("q") > 0)
    asked = want.select("query_id", F.size("q").alias("n"), F.posexplode("q").alias("i", "term"))
    each = rag.select(id_col, F.posexplode(said(rag)).alias("place", "term"))
    met = each.join(asked, "term").groupBy("query_id", id_col, (F.col("place") - F.col("i")).alias("start")).agg(F.count_distinct("i").alias("k"), F.max("n").alias("n"))
    return met.filter("k = n").select("query_id", id_col).distinct()


def search(posted: DataFrame, sizes: DataFrame, queries: DataFrame, *, k: int = 8, rag: DataFrame | None = None, source_type: str | None = None, document: str | None = None, id_col: str = "rag_id", pieces: int = 32) -> DataFrame:
    """query_id, rank, rag_id, score (lower is better) of the k best documents that hold all terms of a query.

    Counts and average length are over the whole index; filters by source_type and document
    come after matching. The best of each of `pieces` parts of a query's hits are found first, so
    that no task ranks all hits of a query.
    """
    asked = asked_terms(queries)
    need = asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("need"))
    whole = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"))
    df = posted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.greatest(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    hits = posted.join(df.crossJoin(F.broadcast(whole)), "term").join(asked, "term").join(sizes, id_col)
    scored = hits.groupBy("query_id", id_col).agg(F.sum(part).alias("s"), F.count(F.lit(1)).alias("have")).join(need, "query_id").filter("have = need")
    scored = scored.select("query_id", id_col, (F.round(-F.col("s"), 6) + F.lit(0.0)).alias("score"))  # no negative zero
    for column, wanted in (("source_type", source_type), ("document_id", document)):
        if wanted is not None:
            scored = scored.join(rag.filter(F.col(column) == wanted).select(id_col), id_col, "left_semi")
    some = Window.partitionBy("query_id", F.pmod(F.xxhash64(id_col), F.lit(pieces))).orderBy("score", id_col)
    best = scored.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", id_col))).filter(F.col("rank") <= k)
