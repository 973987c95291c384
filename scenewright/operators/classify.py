"""Weighted-lexicon classification of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.phrases import with_phrases


def classify_documents(texts: DataFrame, lexicon: DataFrame, *, id_col: str = "document_id", text_col: str = "text", top: int = 5, evidence: int = 12, word_boundary: bool = False) -> DataFrame:
    """id, dimension, rank, label, score, confidence, evidence: the best labels of each dimension.

    lexicon: dimension, label, phrase, weight. A phrase counts once a document if its lower-cased text holds it (as a whole word with
    word_boundary). texts may have several rows an id, pages for instance: each is looked
    at by itself, so that no document's text is put together, and a phrase across two rows
    is not seen. Equal scores keep the lexicon's order (column `position`, or the label).
    """
    if "position" not in lexicon.columns:
        lexicon = lexicon.withColumn("position", F.lit(0))
    low = F.lower(F.regexp_replace(text_col, r"\s+", " "))
    # one automaton goes through each text, whatever the lexicon's size; what comes out is a row a phrase
    rows = with_phrases(texts.select(id_col, low.alias("__low")), lexicon.select("phrase"), text_col="__low", out="__phrases", bounds="word" if word_boundary else "none")
    said = rows.select(id_col, F.explode("__phrases").alias("phrase")).distinct()
    entry = lexicon.groupBy("dimension", "label", "phrase").agg(F.min(F.struct("position", "weight")).alias("__first")).select("dimension", "label", "phrase", "__first.position", "__first.weight")
    hits = said.join(entry, "phrase")
    scored = hits.groupBy(id_col, "dimension", "label").agg(
        F.sum("weight").alias("score"), F.min("position").alias("position"),
        F.transform(F.slice(F.array_sort(F.collect_list(F.struct("position", "phrase"))), 1, evidence), lambda x: x["phrase"]).alias("evidence"),
    )
    each = Window.partitionBy(id_col, "dimension")
    total = F.sum("score").over(each)
    confidence = F.round(F.least(F.lit(0.995), 0.5 + 0.45 * (F.col("score") / F.greatest(F.col("score") + total, F.lit(1)))), 3)
    rank = F.row_number().over(each.orderBy(F.desc("score"), "position", "label"))
    return scored.withColumns({"confidence": confidence, "rank": rank}).filter(F.col("rank") <= top).select(id_col, "dimension", "rank", "label", "score", "confidence", "evidence")


def mixed_notes(classified: DataFrame, *, id_col: str = "document_id", dimensions: tuple[str, ...] = ("narrative_type", "religious_context", "culture"), below: float = 0.62) -> DataFrame:
    """id and a note for each dimension whose best label is under `below`."""
    weak = classified.filter((F.col("rank") == 1) & F.col("dimension").isin(list(dimensions)) & (F.col("confidence") < below))
    name = F.replace(F.concat(F.upper(F.substring("dimension", 1, 1)), F.substring("dimension", 2, 100)), F.lit("_"), F.lit(" "))
    return weak.select(id_col, "dimension", F.concat(name, F.lit(" evidence is mixed; treat classification as provisional.")).alias("note"))


def document_scope(pages: DataFrame, sections: DataFrame, entities: DataFrame) -> DataFrame:
    """document_id, text rows that a document is judged by: page texts, section titles and entity names."""
    return pages.select("document_id", "text").unionByName(sections.select("document_id", F.col("title").alias("text"))).unionByName(entities.select("document_id", F.col("canonical_name").alias("text")))


def visual_role(c: Column, roles: list[tuple[str, str]] | None = None) -> Column:
    """The first role whose pattern matches, else person."""
    out = F.lit("person")
    for role, pattern in reversed(roles or L.ROLES):
        out = F.when(c.rlike(pattern), F.lit(role)).otherwise(out)
    return out
