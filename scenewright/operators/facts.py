"""Facts about characters: extraction, merging, reconciliation, conflicts, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.ranges import first_of
from ..functions.text import quoted, trimmed_items


def profiles(characters: DataFrame, members: DataFrame) -> DataFrame:
    """(profile_id, entity_id): every member of a canonical character maps to the one profile."""
    return characters.select("document_id", F.col("group_id").alias("profile_id"), "canonical_name", "confidence").join(members.select(F.col("group_id").alias("profile_id"), "entity_id", "variant_name"), "profile_id")


def clauses(named: DataFrame, radius: int = 220) -> DataFrame:
    """named (name, context, ...): the clauses around the first hit that hold the name."""
    at = F.instr(F.lower("context"), F.lower("name"))
    start = F.greatest(F.lit(1), at - radius)
    local = F.substr("context", start, at - start + F.length("name") + radius)
    cut = named.filter(F.contains(F.lower("context"), F.lower("name"))).withColumn("clause", F.explode(trimmed_items(F.split(local, r"(?<=[.!?;])\s+|\n+"))))
    return cut.filter((F.col("clause") != "") & F.regexp_like("clause", F.concat(F.lit(r"(?i)\b"), quoted(F.col("name")), F.lit(r"\b"))))


OUTSIDE = ("eyes", "complexion", "face")


def visual_facts(characters: DataFrame, members: DataFrame, mentions: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """profile_id, category, attribute, value, scene_id, evidence, confidence, method: what clauses say of the character they name.

    Equal facts of one clause and scene are kept once. The first rule of an attribute that
    matches wins.
    """
    rules = rules or L.FACT_RULES
    owner = profiles(characters, members).select("document_id", "profile_id", "entity_id", F.col("variant_name").alias("name"))
    said = clauses(owner.join(mentions.drop("document_id"), "entity_id"))
    q = quoted(F.col("name"))
    hits = []
    for rank, (category, attribute, pattern, group, method) in enumerate(rules):
        parts = [p.replace("{{", "{").replace("}}", "}") for p in pattern.split("{name}")]
        whole = [F.lit("(?i)" + parts[0])]
        for p in parts[1:]:
            whole += [q, F.lit(p)]
        value = F.btrim(F.call_function("regexp_extract", F.col("clause"), F.concat(*whole), F.lit(group)), F.lit(" \t\r\n,.;:!?\"'()[]"))
        value = F.substring(F.regexp_replace(value, r"\s+", " "), 1, 300)
        if attribute in OUTSIDE:  # the name must stand beside the hit, not in it
            rest = F.replace(F.lower("clause"), F.lower(value), F.lit(" "))
            value = F.when((value != "") & F.regexp_like(rest, F.concat(F.lit(r"(?i)\b"), q, F.lit(r"\b"))), value).otherwise("")
        hits.append(F.struct(F.lit(rank).alias("rank"), F.lit(category).alias("category"), F.lit(attribute).alias("attribute"), value.alias("value"), F.lit(method).alias("method")))
    found = said.withColumn("h", F.explode(F.filter(F.array(*hits), lambda h: h["value"] != "")))
    keys = ["document_id", "profile_id", "scene_id", "clause"]
    best = found.groupBy(*keys, F.col("h.category").alias("category"), F.col("h.attribute").alias("attribute")).agg(F.min(F.struct(F.col("h.rank").alias("rank"), F.col("h.value").alias("value"), F.col("h.method").alias("method"), "confidence")).alias("b"))
    return best.select("document_id", "profile_id", "category", "attribute", "b.value", "scene_id", F.col("clause").alias("evidence"), F.least(F.lit(0.98), F.greatest(F.lit(0.35), F.col("b.confidence"))).alias("confidence"), "b.method").dropDuplicates(["profile_id", "category", "attribute", "value", "scene_id", "evidence"])


def scene_context(scenes: DataFrame, mentions: DataFrame, owners: DataFrame, objects: DataFrame) -> DataFrame:
    """Per scene the sorted profile ids of the characters mentioned, and its own objects."""
    people = mentions.join(owners.select("entity_id", "profile_id"), "entity_id").groupBy("scene_id").agg(F.array_sort(F.collect_set("profile_id")).alias("character_profile_ids"))
    things = objects.groupBy("scene_id").agg(F.array_sort(F.collect_set("object")).alias("objects"))
    out = scenes.select("document_id", "scene_id").join(people, "scene_id", "left").join(things, "scene_id", "left")
    return out.withColumns({"character_profile_ids": F.coalesce("character_profile_ids", F.array().cast(people.schema["character_profile_ids"].dataType)), "objects": F.coalesce("objects", F.array().cast("array<string>"))})


def canonical_facts(facts: DataFrame, *, owner: str = "profile_id") -> DataFrame:
    """Facts of equal (category, attribute, value) as one: highest confidence (0.99 at most), first evidence, scene if it is the only one.

    Values of an attribute that contradict each other are all kept, and marked.
    """
    keys = [owner, "category", "attribute", "value"]
    first = F.min(F.struct(F.coalesce("scene_id", F.lit(9223372036854775807)).alias("s"), "evidence"))
    one = facts.groupBy(*keys).agg(F.least(F.lit(0.99), F.max("confidence")).alias("confidence"), first.alias("f"), F.count_distinct("scene_id").alias("n"), F.max("scene_id").alias("s"), F.count(F.lit(1)).alias("occurrences"))
    out = one.select(*keys, "confidence", F.col("f.evidence").alias("evidence"), F.when(F.col("n") == 1, F.col("s")).alias("scene_id"), "occurrences")
    values = F.count(F.lit(1)).over(Window.partitionBy(owner, "category", "attribute"))
    return out.withColumn("contradictory", values > 1)


def reconcile_facts(facts: DataFrame, types: dict[str, list[str]] | None = None, *, owner: str = "profile_id", id_col: str = "fact_id") -> DataFrame:
    """Each value with its state type, status (conflict where a stable attribute has several values), least confidence, scenes and facts."""
    kinds = types or L.STATE_TYPES
    pairs = [x for kind, names in kinds.items() for name in names for x in (F.lit(name), F.lit(kind))]
    state = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("attribute")), F.lit("contextual"))
    one = facts.groupBy(owner, "category", "attribute", "value").agg(F.min("confidence").alias("confidence"), F.array_sort(F.collect_set("scene_id")).alias("scene_ids"), F.array_sort(F.collect_set(id_col)).alias("fact_ids"))
    n = F.count(F.lit(1)).over(Window.partitionBy(owner, "category", "attribute"))
    out = one.withColumn("state_type", state)
    return out.withColumn("status", F.when((F.col("state_type") == "stable") & (n > 1), "conflict").otherwise("supported"))


def classify_conflicts(reconciled: DataFrame, *, owner: str = "profile_id") -> DataFrame:
    """Conflicting values: low_evidence, scene_scoped (other values have other scenes) or strong_conflict."""
    clash = reconciled.filter("status = 'conflict'")
    every = F.size(F.array_distinct(F.flatten(F.collect_list("scene_ids").over(Window.partitionBy(owner, "attribute")))))
    own = F.size("scene_ids")
    kind = F.when(F.col("confidence") < 0.6, "low_evidence").when((own > 0) & (every > own), "scene_scoped").otherwise("strong_conflict")
    return clash.withColumn("classification", kind)


def scene_state(mentions: DataFrame, owners: DataFrame, facts: DataFrame) -> DataFrame:
    """Characters present in each scene with the facts of that scene or of none, nested."""
    there = mentions.join(owners.select("entity_id", "profile_id", "canonical_name"), "entity_id").select("document_id", "scene_id", "profile_id", "canonical_name").distinct()
    told = facts.select("profile_id", "scene_id", "category", "attribute", "value", "confidence")
    own = there.join(told.filter("scene_id IS NOT NULL"), ["profile_id", "scene_id"])
    lasting = there.join(told.filter("scene_id IS NULL").drop("scene_id"), "profile_id").select(own.columns)
    bare = there.select(*[F.col(c) if c in there.columns else F.lit(None).cast(own.schema[c].dataType).alias(c) for c in own.columns])
    met = own.unionByName(lasting).unionByName(bare)
    fact = F.when(F.col("attribute").isNotNull(), F.struct("category", "attribute", "value", "confidence"))
    return met.groupBy("document_id", "scene_id", "profile_id", "canonical_name").agg(F.array_sort(F.collect_list(fact)).alias("facts"))


def character_context(characters: DataFrame, aliases: DataFrame, facts: DataFrame, *, scene_id: int | None = None) -> DataFrame:
    """Per character its aliases and facts by category; with scene_id only that scene's facts and those of none."""
    kept = facts.filter(F.col("scene_id").isNull() | (F.col("scene_id") == scene_id)) if scene_id is not None else facts
    by_category = kept.groupBy("profile_id", "category").agg(F.array_sort(F.collect_list(F.struct("attribute", "value", "confidence"))).alias("facts")).groupBy("profile_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "facts")))).alias("facts_by_category"))
    names = aliases.groupBy(F.col("group_id").alias("profile_id")).agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    return characters.withColumnRenamed("group_id", "profile_id").join(names, "profile_id", "left").join(by_category, "profile_id", "left")


def canonical_profiles(characters: DataFrame, members: DataFrame) -> DataFrame:
    """characters with source_ids, their members by falling confidence, then by id."""
    best = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "entity_id"))), lambda m: m["entity_id"])
    return characters.join(members.groupBy("document_id", "group_id").agg(best.alias("source_ids")), ["document_id", "group_id"])


def profile_reads(profiles: DataFrame, facts: DataFrame, kind: str, *, name: str | None = None) -> DataFrame:
    """Profiles (document_id, profile_id, profile_type, canonical_name, confidence) of a kind (character, environment, object) with their facts by falling confidence.

    With name, of each document's profiles of that name the one of highest confidence, then lowest id.
    """
    rows = profiles.filter(F.col("profile_type") == kind)
    if name is not None:
        rows = first_of(rows.filter(F.col("canonical_name") == name), ["document_id"], [F.desc("confidence"), F.col("profile_id")])
    told = facts.groupBy("profile_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "fact_id", "attribute", "value"))).alias("f"))
    shown = F.transform("f", lambda x: F.struct(x["attribute"].alias("attribute"), x["value"].alias("value"), (-x["c"]).alias("confidence")))
    return rows.join(told, "profile_id", "left").withColumn("facts", F.coalesce(shown, F.array().cast("array<struct<attribute:string,value:string,confidence:double>>"))).drop("f")


def expanded_context(context: DataFrame, profiles: DataFrame, *, ids: dict[str, str]) -> DataFrame:
    """Scenes (scene_id and arrays of profile ids) with an array of (canonical_name, confidence) for each array, in its order; unknown ids are left out. ids: array column -> name of the new one."""
    out = context
    for column, name in ids.items():
        each = context.select("scene_id", F.posexplode(column).alias("at", "profile_id")).join(profiles.select("profile_id", "canonical_name", "confidence"), "profile_id")
        held = each.groupBy("scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "canonical_name", "confidence"))), lambda x: F.struct(x["canonical_name"].alias("canonical_name"), x["confidence"].alias("confidence"))).alias(name))
        out = out.join(held, "scene_id", "left").withColumn(name, F.coalesce(name, F.array().cast(held.schema[name].dataType)))
    return out


def audit(scenes: DataFrame, profiled: DataFrame, facts: DataFrame, context: DataFrame, *, n: int = 10) -> DataFrame:
    """section, metric, value: coverage, fact quality, continuity and noise."""
    share = lambda a, b: F.round(100.0 * a / F.greatest(b, F.lit(1)), 3)
    row = lambda section, metric, value: F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), value.cast("double").alias("value"))
    counts = scenes.agg(F.count(F.lit(1)).alias("scenes")).crossJoin(profiled.agg(F.count(F.lit(1)).alias("profiles"), F.count_if((F.length("canonical_name") > 45) | (F.size(F.split("canonical_name", " ")) >= 4) | (F.col("confidence") < 0.5)).alias("suspicious")))
    counts = counts.crossJoin(facts.agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.btrim("evidence") != "").alias("with_evidence"))).crossJoin(context.agg(F.count(F.lit(1)).alias("contexts"), F.count_if(F.size("character_profile_ids") > 0).alias("with_people"), F.count_if(F.size("objects") > 0).alias("with_objects")))
    several = facts.groupBy("profile_id").agg(F.count_distinct("scene_id").alias("s")).agg(F.count_if(F.col("s") > 1).alias("multi"))
    c = counts.crossJoin(several)
    return c.select(F.explode(F.array(
        row("coverage", "scenes", F.col("scenes")), row("coverage", "profiles", F.col("profiles")), row("coverage", "facts", F.col("facts")),
        row("coverage", "scenes_with_context_percent", share(F.col("contexts"), F.col("scenes"))), row("coverage", "facts_with_evidence_percent", share(F.col("with_evidence"), F.col("facts"))),
        row("continuity", "scenes_with_characters", F.col("with_people")), row("continuity", "scenes_with_objects", F.col("with_objects")), row("continuity", "profiles_in_several_scenes", F.col("multi")),
        row("noise", "suspicious_names", F.col("suspicious")),
    )).alias("r")).select("r.*")


def duplicate_names(entities: DataFrame) -> DataFrame:
    """Normalised names that several entities of a document share."""
    return entities.groupBy("document_id", F.lower(F.btrim("canonical_name")).alias("name")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def noisy_names(entities: DataFrame, n: int) -> DataFrame:
    """The n most dubious names: many words, long, or of low confidence."""
    odd = (F.size(F.split("canonical_name", " ")) >= 4) | (F.length("canonical_name") > 45) | (F.col("confidence") < 0.5)
    return entities.filter(odd).orderBy(F.desc(F.length("canonical_name")), "canonical_name", "document_id").limit(n)


def integrity_checks(checks: dict[str, tuple[DataFrame, int | None]]) -> DataFrame:
    """check, value, passed: the row count of each DataFrame against the count that is wanted (None: any above zero)."""
    out = None
    for name, (df, wanted) in checks.items():
        n = F.count(F.lit(1))
        row = df.agg(n.alias("value")).select(F.lit(name).alias("check"), "value", ((F.col("value") > 0) if wanted is None else (F.col("value") == wanted)).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out


def fact_distribution(profiled: DataFrame, facts: DataFrame) -> DataFrame:
    """kind, name, n, mean_confidence, with_evidence: profiles by type, and facts by category."""
    types = profiled.groupBy(F.lit("profile_type").alias("kind"), F.col("profile_type").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 3).alias("mean_confidence"), F.lit(None).cast("long").alias("with_evidence"))
    kinds = facts.groupBy(F.lit("category").alias("kind"), F.col("category").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 3).alias("mean_confidence"), F.count_if(F.btrim("evidence") != "").alias("with_evidence"))
    return types.unionByName(kinds)


def readiness(scenes: DataFrame, context: DataFrame, facts: DataFrame, *, covered: float = 95.0, mean: float = 0.55) -> DataFrame:
    """One row: whether contexts cover the scenes, facts have evidence, and the mean of the categories' mean confidences reaches its mark; the share of these as a score."""
    share = lambda a, b: F.when(b > 0, F.round(100.0 * a / b, 2)).otherwise(0.0)
    held = facts.agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.btrim("evidence") != "").alias("told"))
    means = facts.groupBy("category").agg(F.avg("confidence").alias("c")).agg(F.coalesce(F.round(F.avg("c"), 3), F.lit(0.0)).alias("mean"))
    one = scenes.agg(F.count(F.lit(1)).alias("scenes")).crossJoin(context.agg(F.count(F.lit(1)).alias("contexts"))).crossJoin(held).crossJoin(means)
    checks = one.select((share(F.col("contexts"), F.col("scenes")) >= covered).alias("context_ok"), (share(F.col("told"), F.col("facts")) >= covered).alias("evidence_ok"), (F.col("mean") >= mean).alias("confidence_ok"))
    passed = sum(F.col(c).cast("int") for c in checks.columns)
    return checks.withColumn("score", F.round(100.0 * passed / 3, 1)).withColumn("status", F.when(passed == 3, "PASS").otherwise("NEEDS_REVIEW"))


def top_samples(profiled: DataFrame, facts: DataFrame, n: int) -> DataFrame:
    """kind, rank, name, confidence: the n profiles and the n facts of highest confidence (top-k reports)."""
    rows = profiled.select(F.lit("profile").alias("kind"), F.col("canonical_name").cast("string").alias("name"), "confidence").orderBy(F.desc("confidence"), "name").limit(n)
    said = facts.select(F.lit("fact").alias("kind"), F.concat_ws(" ", F.col("profile_id").cast("string"), "attribute", "value").alias("name"), "confidence").orderBy(F.desc("confidence"), "name").limit(n)
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("confidence"), "name"))
    return rows.unionByName(said).withColumn("rank", place)


def release_checks(*, profiles: DataFrame, canonical: DataFrame, facts: DataFrame, classified: DataFrame, reconciled: DataFrame, characters: DataFrame, context: DataFrame, objects: DataFrame, continuity: DataFrame, states: DataFrame, bad_phrases: list[str] = ()) -> DataFrame:
    """check, value, passed of a document's layers: counts that must not be zero, must be zero, or must agree.

    profiles: one row for each canonical profile (profile_id); characters: the canonical
    characters (profile_id) that must each have one.
    """
    bad = F.lit(False)
    for phrase in bad_phrases:
        bad = bad | F.contains(F.lower("evidence"), F.lit(phrase)) | F.contains(F.lower("value"), F.lit(phrase))
    none, some = (lambda v: v == 0), (lambda v: v > 0)
    rows = [
        ("canonical_profiles", profiles, some), ("canonical_facts", canonical, some), ("strong_conflicts", classified.filter("classification = 'strong_conflict'"), none),
        ("unsupported", reconciled.filter("status = 'unsupported'"), none), ("known_bad_phrase_facts", facts.filter(bad), none), ("canonical_characters", characters, some),
        ("characters_without_profile", characters.join(profiles, "profile_id", "left_anti"), none), ("scene_context_rows", context, some), ("object_mentions", objects, some), ("continuity_rows", continuity, some), ("continuity_state_rows", states, some),
    ]
    out = None
    for name, df, rule in rows:
        row = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("check"), "value", rule(F.col("value")).alias("passed"))
        out = row if out is None else out.unionByName(row)
    sizes = F.max(F.when(F.col("check") == "canonical_profiles", F.col("value"))).over(Window.partitionBy(F.lit(1))) == F.max(F.when(F.col("check") == "canonical_characters", F.col("value"))).over(Window.partitionBy(F.lit(1)))
    return out.withColumn("passed", F.col("passed") & (~F.col("check").isin("canonical_profiles", "canonical_characters") | sizes))
