"""Entities: candidates in scenes, mentions, profiles, merges and aliases."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import lexicons as L
from ..functions.phrases import small_batches, with_phrases
from ..functions.ranges import first_of
from ..functions.text import context_at, entity_key

_NAME = r"[A-Z][A-Za-z'-]+"
TITLED = rf"\b{L.any_of(L.TITLES)}\s+{_NAME}(?:\s+{_NAME}){{0,2}}"
SPOKEN = rf"\b([A-Z][A-Za-z'-]{{2,}}(?:\s+{_NAME}){{0,2}})\s+{L.any_of(L.SPEECH_VERBS)}\b"
PROPER = r"\b[A-Z][a-z]{2,}(?:\s+[A-Z][a-z]{2,}){0,2}\b"
PLACE = rf"\b{L.any_of(L.PLACE_CUES)}\s+(?:the\s+)?({_NAME}(?:\s+{_NAME}){{0,3}})"
SETTING = rf"(?i)\b(?:the\s+)?[A-Za-z][A-Za-z'-]*(?:\s+[A-Za-z][A-Za-z'-]*)?\s+{L.any_of(L.SETTINGS)}\b"
EDGES = " \t\r\n,.;:!?\"'()[]"
#: (entity type, pattern, group, confidence, rank: lower wins, checked against the stop list)
RULES = [("character", TITLED, 0, 0.8, 0, False), ("character", SPOKEN, 1, 0.75, 1, True), ("character", PROPER, 0, 0.45, 2, True), ("location", PLACE, 1, 0.6, 3, True), ("environment", SETTING, 0, 0.65, 4, False)]


def clean(c: Column) -> Column:
    return F.regexp_replace(F.btrim(c, F.lit(EDGES)), r"\s+", " ")


@F.pandas_udf(ArrayType(StringType()))
def contexts_of(texts: pd.Series, lows: pd.Series, names: pd.Series, low_names: pd.Series) -> pd.Series:
    """What `context_window` gives for each name of a text. The built-in functions walk a text from its start for each name and
    each cut, which is most of the cost of long texts; here a cut costs its own length."""

    def around(text: str, low: str, name: str, low_name: str, radius: int = 220) -> str:
        at = low.find(low_name)
        return text[: radius if at < 0 else at + len(name) + radius][max(0, at - radius) :].strip(" ")

    return pd.Series([None if ns is None else [around(t, low, n, m) for n, m in zip(ns, ms, strict=True)] for t, low, ns, ms in zip(texts, lows, names, low_names, strict=True)], dtype=object)


def extract_mentions(scenes: DataFrame, rules: list[tuple] | None = None, stop: list[str] | None = None, *, contexts: bool = True) -> DataFrame:
    """One row per scene, type and name: its confidence by the best rule, and (with contexts) the text around its first hit.

    A character name that is also a place or setting of the scene is left out. All of it is
    done inside a scene's row, so that no text is copied or shuffled.
    """
    rules, stop = rules or RULES, L.NAME_STOP if stop is None else stop

    #: A word that is too short or on the stop list.
    bad = rf"(?<![^ ])(?:[^ ]{{0,2}}|{'|'.join(re.escape(w) for w in stop)})(?![^ ])" if stop else r"(?<![^ ])[^ ]{0,2}(?![^ ])"

    def hits_of(kind: str, pattern: str, group: int, confidence: float, rank: int, checked: bool) -> Column:
        found = F.transform(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))), clean)
        kept = F.filter(found, lambda n: (n != "") & ~n.rlike(bad) if checked else n != "")
        told = lambda n: F.struct(F.lit(kind).alias("entity_type"), n.alias("canonical_name"), F.lit(rank).alias("rank"), F.lit(float(confidence)).alias("confidence"))
        return F.transform(F.array_distinct(kept), told)

    same = lambda x, y: (x["entity_type"] == y["entity_type"]) & (x["canonical_name"] == y["canonical_name"])
    if len(rules) == 1:  # the names of one rule differ, so there is nothing to choose
        rows = scenes.withColumn("__best", hits_of(*rules[0]))
    else:
        rows = scenes.withColumn("__hits", F.array_sort(F.concat(*[hits_of(*rule) for rule in rules])))
        rows = rows.withColumn("__best", F.filter("__hits", lambda x, i: (i == 0) | ~same(x, F.get("__hits", i - 1))))
    placed = {rule[0] for rule in rules} & {"location", "environment"}
    places = F.transform(F.filter("__best", lambda x: x["entity_type"].isin("location", "environment")), lambda x: F.lower(x["canonical_name"]))
    rows = rows.withColumn("__places", places if placed else F.array().cast("array<string>"))
    here = F.lit(None).cast("array<string>")
    if contexts:
        small_batches(scenes.sparkSession)
        here = contexts_of("text", F.lower("text"), F.transform("__best", lambda x: x["canonical_name"]), F.transform("__best", lambda x: F.lower(x["canonical_name"])))
    rows = rows.withColumn("__contexts", here)
    fields = lambda x, i: [x["entity_type"].alias("entity_type"), x["canonical_name"].alias("canonical_name"), x["confidence"].alias("confidence"), *([F.get("__contexts", i).alias("context")] if contexts else [])]
    said = F.transform("__best", lambda x, i: F.struct(*fields(x, i)))
    if placed:
        said = F.filter(said, lambda x: (x["entity_type"] != "character") | ~F.array_contains("__places", F.lower(x["canonical_name"])))
    others = [c for c in scenes.columns if c not in ("text", "title", "strategy")]
    return rows.select(*others, F.explode(said).alias("__m")).select(*others, "__m.*")


#: The mentions of one name are summed up in so many parts first.
PARTS = 64


def entities(mentions: DataFrame, *, order: list[str], contexts: int = 5) -> DataFrame:
    """One row per document, type and name: confidence of the first sighting, and the first contexts as a profile."""
    first = F.struct(*order)
    keys = ["document_id", "entity_type", "canonical_name"]
    # as one struct, in which nulls are equal, so that one division by key serves both groupings and the join
    keyed = mentions.withColumn("__key", F.struct(*keys))
    counts = keyed.groupBy("__key").agg(F.min(F.struct(first.alias("first"), "confidence")).alias("first"), F.count(F.lit(1)).alias("mention_count"))
    # of each task's mentions of a name only the first few are moved, and these once
    place = F.row_number().over(Window.partitionBy("__key").orderBy(*order, "context"))
    few = keyed.select("__key", *order, "context").withColumn("__n", place).filter(F.col("__n") <= contexts)
    profile = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "context"))), lambda x: x["context"]), "\n\n")
    told = few.groupBy("__key").agg(profile.alias("profile_text"))
    return told.join(counts, "__key").select(*[F.col(f"__key.{k}").alias(k) for k in keys], F.col("first.confidence").alias("confidence"), "profile_text", "mention_count")


def merge_exact(entities: DataFrame, *, id_col: str = "entity_id", name: str = "canonical_name") -> DataFrame:
    """entities with canonical_id: of equal keys and types the one of highest confidence, then lowest id."""
    w = Window.partitionBy("document_id", "entity_type", entity_key(F.col(name))).orderBy(F.desc("confidence"), id_col)
    return entities.withColumn("canonical_id", F.first(id_col).over(w))


def merge_titled(entities: DataFrame, honorifics: list[str] | None = None) -> DataFrame:
    """(short id -> full id) of characters whose name is the last part of exactly one kind of titled name of no lower confidence."""
    people = entities.filter("entity_type = 'character'").select("document_id", "entity_id", "canonical_name", "confidence", entity_key(F.col("canonical_name")).alias("key"))
    parts = F.split("canonical_name", r"\s+")
    full = people.withColumn("parts", parts).filter((F.size("parts") >= 2) & F.regexp_replace(F.lower(F.col("parts")[0]), r"\.$", "").isin(honorifics or L.HONORIFICS))
    full = full.withColumn("last", F.element_at("parts", -1)).filter(F.length("last") >= 4)
    full = full.select("document_id", F.col("entity_id").alias("full_id"), F.col("confidence").alias("full_confidence"), entity_key(F.col("last")).alias("key"))
    only = people.groupBy("document_id", "key").agg(F.count(F.lit(1)).alias("n"), F.first("entity_id").alias("entity_id"), F.first("canonical_name").alias("alias"), F.first("confidence").alias("confidence")).filter("n = 1")
    pairs = full.join(only, ["document_id", "key"]).filter("full_confidence >= confidence AND full_id <> entity_id")
    return first_of(pairs, ["document_id", "entity_id"], [F.desc("full_id")]).select("document_id", "entity_id", F.col("full_id").alias("canonical_id"), "alias")


def resolve_entities(entities: DataFrame, mentions: DataFrame, honorifics: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, mentions, aliases) after both merges; mentions and entities carry an entity_id."""
    exact = merge_exact(entities).select("document_id", "entity_id", "canonical_id", "canonical_name", "confidence", "entity_type")
    winners = entities.join(exact.select(F.col("canonical_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    titled = merge_titled(winners, honorifics)
    t = titled.select(F.col("entity_id").alias("__short"), F.col("canonical_id").alias("__full"))
    mapping = exact.join(t, F.col("canonical_id") == F.col("__short"), "left").select("document_id", "entity_id", F.coalesce("__full", "canonical_id").alias("canonical_id"), "canonical_name", "confidence")
    moved = mentions.join(mapping.select("entity_id", F.col("canonical_id").alias("__to")), "entity_id", "left").withColumn("entity_id", F.coalesce("__to", "entity_id")).drop("__to")
    order = [c for c in ("page_start", "scene_order") if c in mentions.columns]
    # the first twelve of each part of an entity's mentions, then of all: no row holds all contexts
    told = F.struct(*order, "context")
    part = moved.select("entity_id", "confidence", told.alias("told"), F.pmod(F.xxhash64(told), F.lit(PARTS)).alias("part"))
    early = part.withColumn("n", F.row_number().over(Window.partitionBy("entity_id", "part").orderBy("told"))).filter("n <= 12")
    profile = F.substring(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list("told")), 1, 12), lambda x: x["context"]), "\n\n"), 1, 6000)
    fresh = early.groupBy("entity_id").agg(profile.alias("__profile")).join(moved.groupBy("entity_id").agg(F.max("confidence").alias("__confidence")), "entity_id")
    kept = winners.join(t, F.col("entity_id") == F.col("__short"), "left_anti").join(fresh, "entity_id", "left")
    kept = kept.withColumns({"confidence": F.coalesce("__confidence", "confidence"), "profile_text": F.coalesce("__profile", "profile_text")}).drop("__confidence", "__profile")
    spelled = mapping.select("document_id", F.col("canonical_id").alias("entity_id"), F.col("canonical_name").alias("alias"), F.lit("source_spelling").alias("method"), F.lit(1.0).alias("confidence"), F.lit(1).alias("rank"))
    by_key = exact.filter("entity_id <> canonical_id").select("document_id", F.col("canonical_id").alias("entity_id"), F.col("canonical_name").alias("alias"), F.lit("normalized_exact").alias("method"), F.least("confidence", F.lit(0.95)).alias("confidence"), F.lit(0).alias("rank"))
    by_title = titled.select("document_id", F.col("canonical_id").alias("entity_id"), "alias", F.lit("titled_name_variant").alias("method"), F.lit(0.82).alias("confidence"), F.lit(0).alias("rank"))
    every = spelled.unionByName(by_key).unionByName(by_title).withColumn("__low", F.lower("alias"))
    aliases = first_of(every, ["document_id", "entity_id", "__low"], [F.col("rank"), F.col("alias"), F.desc("confidence"), F.col("method")]).drop("rank", "__low")
    return kept, moved, aliases


def object_mentions(scenes: DataFrame, lexicon: list[str] | DataFrame | None = None, *, keys: list[str], radius: int = 180) -> DataFrame:
    """One row per scene and lexicon word that occurs in it: name, text around the first hit, confidence 0.55.

    Words are looked up inside the scene's row by one automaton over the whole lexicon (a list,
    or a table whose first column holds it), and the text around them is cut out there too, so
    no text is copied or shuffled.
    """
    rows = scenes.select(*keys, "text", F.lower("text").alias("__low"))
    found = with_phrases(rows, L.PROPS if lexicon is None else lexicon, text_col="__low", out="__terms", bounds="token")
    placed = F.transform("__terms", lambda t: F.struct(t.alias("term"), F.instr(F.col("__low"), t).alias("at")))
    hits = F.transform(placed, lambda x: F.struct(F.initcap(x["term"]).alias("object"), context_at(F.col("text"), x["at"], F.length(x["term"]), radius).alias("evidence")))
    return found.select(*keys, F.explode(hits).alias("__hit")).select(*keys, "__hit.object", "__hit.evidence", F.lit(0.55).alias("confidence"))
