"""Queries over generation plans, audits, assembled scenes and the smaller text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_limit, rebuild_paragraphs, strip_quotes, trimmed_items, unique_limit
from ..operators import continuity, entities, facts, packages, plans
from . import books, tables


def plan_packages(spark, sf_dir):
    """Each document as a scene with its title, names, moments and quoted lines."""
    made = books.rendered(spark, sf_dir).select(F.col("doc_id").alias("scene_id"), "title", "text", "names", "moments", "page_start", "page_end")
    quotes = F.filter(trimmed_items(F.regexp_extract_all("text", F.lit(packages.QUOTES), 1)), lambda s: packages.words(s) >= 3)
    return made.withColumn("dialogue", F.slice(F.array_distinct(quotes), 1, 3))


def plan_prompts(spark, sf_dir):
    """Prompts of image, clips and shots."""
    made = plans.build_plans(plan_packages(spark, sf_dir))
    text = lambda c: F.md5(F.array_join(F.transform(c, lambda x: x["prompt"]), "\n"))
    return made.select(F.col("scene_id").alias("doc_id"), "direction", F.md5("image_prompt").alias("image_md5"), text("short_video.clips").alias("clips_md5"), text("long_video.shots").alias("shots_md5"), F.size("long_video.shots").alias("shots"))


def plan_quality(spark, sf_dir):
    checked = plans.plan_errors(plans.build_plans(plan_packages(spark, sf_dir)))
    return checked.select(F.col("scene_id").alias("doc_id"), F.array_join("errors", ",").alias("errors"), "status")


def plan_audit(spark, sf_dir):
    return plans.audit_summary(plans.audit_plans(plans.plan_errors(plans.build_plans(plan_packages(spark, sf_dir)))))


def typed_profiles(spark, sf_dir):
    told = tables.event_facts(spark, sf_dir)
    kind = F.when(F.col("profile_id") % 3 == 0, "environment").when(F.col("profile_id") % 3 == 1, "object").otherwise("character")
    return told.groupBy("profile_id").agg(F.round(F.avg("confidence"), 4).alias("confidence")).withColumns({"canonical_name": F.col("profile_id").cast("string"), "profile_type": kind})


def fact_distribution(spark, sf_dir):
    told = tables.event_facts(spark, sf_dir).withColumn("category", F.col("attribute"))
    return facts.fact_distribution(typed_profiles(spark, sf_dir), told)


def audit_readiness(spark, sf_dir):
    told = tables.event_facts(spark, sf_dir).withColumn("category", F.col("attribute"))
    return facts.readiness(told.select("scene_id").distinct(), told.filter("confidence > 0.9").select("scene_id").distinct(), told)


def audit_samples(spark, sf_dir):
    """A top-k report: the 10 profiles and 10 facts of highest confidence."""
    return facts.top_samples(typed_profiles(spark, sf_dir), tables.event_facts(spark, sf_dir), 10)


def release_checks(spark, sf_dir):
    told = tables.event_facts(spark, sf_dir)
    known = facts.reconcile_facts(told)
    profiled = told.select("profile_id").distinct()
    users = tables.read(spark, sf_dir, "events").select(F.col("user_id").alias("profile_id")).distinct()
    states = tables.states(spark, sf_dir)
    return facts.release_checks(
        profiles=profiled, canonical=facts.canonical_facts(told), facts=told, classified=facts.classify_conflicts(known), reconciled=known, characters=users,
        context=told.select("scene_id").distinct(), objects=told.filter("attribute = 'hair'"), continuity=told.select("scene_id").distinct(), states=states, bad_phrases=["e77"],
    )


def scene_assembly(spark, sf_dir):
    """Stretches of 200 events as scenes: their users with facts and mentions, kinds of events as objects, and neighbours."""
    told = tables.event_facts(spark, sf_dir)
    scenes = told.select("scene_id").distinct().withColumn("document_id", F.lit(1))
    there = told.select("scene_id", "profile_id").distinct().withColumns({"canonical_name": F.lpad(F.col("profile_id").cast("string"), 9, "0"), "aliases": F.array().cast("array<string>")})
    said = told.withColumn("scene_id", F.when(F.col("attribute") == "hair", F.lit(None)).otherwise(F.col("scene_id"))).select("profile_id", "scene_id", "category", "attribute", "value", "confidence")
    out = plans.scene_assembly(
        scenes, characters=there, facts=said, mentions=told.select("scene_id", "profile_id"), objects=told.select("scene_id", F.col("value").alias("object")).distinct(),
        events=told.select("scene_id", F.col("fact_id").alias("event_order"), F.col("evidence").alias("text")), continuity=there.select("scene_id", F.col("profile_id").alias("entity_id"), F.lit("present").alias("status")), order=["scene_id"],
    )
    first = F.transform(F.col("characters")[0]["facts"], lambda x: F.concat_ws("=", x["attribute"], x["value"]))
    return out.select(
        "scene_id", F.size("characters").alias("characters"), F.aggregate("characters", F.lit(0).cast("long"), lambda n, c: n + c["mentions"]).alias("mentions"), F.aggregate("characters", F.lit(0), lambda n, c: n + F.size(c["facts"])).alias("facts"),
        F.array_join(first, ",").alias("first_facts"), F.array_join(F.transform("objects", lambda x: x["object"]), ",").alias("objects"), F.size("events").alias("events"), F.size("continuity").alias("states"), "previous_id", "next_id",
    )


def clean_openings(spark, sf_dir):
    return books.documents(spark, sf_dir).select("doc_id", F.md5(clean_limit(F.col("text"), 300)).alias("opening_md5"))


def first_words(spark, sf_dir):
    """The first 12 words of a document that differ, whatever their case."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return books.documents(spark, sf_dir).select("doc_id", F.array_join(unique_limit(words, 12), " ").alias("words"))


def unquoted_texts(spark, sf_dir):
    return books.documents(spark, sf_dir).select("doc_id", F.md5(strip_quotes(F.col("text"))).alias("text_md5"))


def paragraphs(spark, sf_dir):
    return books.documents(spark, sf_dir).select("doc_id", F.md5(rebuild_paragraphs(F.col("text"))).alias("text_md5"))


SPOKEN = r"(?i)\b(?:that|que|dass|und)\b"


def dialogue_ranked(spark, sf_dir):
    """The best 3 quotes of a document whose lines are taken as quotes, by length and a word of speech near."""
    docs = books.documents(spark, sf_dir).select("doc_id", F.concat(F.lit('"'), F.replace("text", F.lit("\n"), F.lit('" "')), F.lit('"')).alias("text"))
    return packages.dialogue(docs, "ranked", keys=["doc_id"], spoken=SPOKEN).select("doc_id", "rank", F.md5("line").alias("line_md5"), "score")


def inferred_attributes(spark, sf_dir):
    """What the facts tell of a user, and what the role of the user's last digit supposes of other attributes."""
    known = facts.reconcile_facts(tables.event_facts(spark, sf_dir))
    roles = known.select("profile_id").distinct().withColumn("role", F.when(F.col("profile_id") % 2 == 0, "reader").otherwise("buyer"))
    priors = spark.createDataFrame([("reader", "build", "slight"), ("reader", "hair", "unknown"), ("buyer", "build", "tall")], "role string, attribute string, value string")
    return packages.infer_attributes(known, priors, roles)


def titled_merge(spark, sf_dir):
    """Parts as people of documents of 20: the first word of a part's name, titled for even keys."""
    p = tables.read(spark, sf_dir, "part")
    word = F.initcap(F.split("p_name", " ")[0])
    named = p.select(F.floor(F.col("p_partkey") / 20).alias("document_id"), F.col("p_partkey").alias("entity_id"), F.lit("character").alias("entity_type"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Captain "), word)).otherwise(word).alias("canonical_name"), F.round(F.col("p_size") / 50, 2).alias("confidence"))
    return entities.merge_titled(named).select("document_id", "entity_id", "canonical_id", "alias")


#: A capital word before a long one stands for a setting; names of the same spelling are then no characters.
SETTING_RULES = [*books.NAME_RULE, ("environment", "([A-Z][a-z]{2,}) [a-z]{8,}", 1, 0.65, 4, False)]


def place_mentions(spark, sf_dir):
    """Settings, and the names that are not taken for one in the same document."""
    said = entities.extract_mentions(books.page_scenes(spark, sf_dir), SETTING_RULES)
    return said.select(F.col("scene_order").alias("doc_id"), "entity_type", "canonical_name", "confidence")


def presence_lists(spark, sf_dir):
    """At most 6 visible and 8 other names of a document, by its text as an event and by the names' contexts."""
    said = books.name_mentions(spark, sf_dir)
    keys = ["scene_order"]
    events = books.page_scenes(spark, sf_dir).select("scene_order", "text")
    out = packages.presence(None, events, said, keys=keys, visible=6, referenced=8)
    return out.select(F.col("scene_order").alias("doc_id"), "canonical_name", "visible")


def canonical_id_map(spark, sf_dir):
    """Suppliers of each order's lines, in order, as their nations; suppliers without balance are unmapped."""
    lines = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("scene_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    owners = tables.read(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("entity_id"), F.col("s_nationkey").alias("canonical_id"))
    out = continuity.canonical_ids(lines.select("scene_id", F.transform("l", lambda x: x["l_suppkey"]).alias("entity_ids")), owners)
    return out.select("scene_id", F.array_join(F.transform("canonical_ids", lambda x: x.cast("string")), ",").alias("canonical_ids"))


QUERIES = {f.__name__: f for f in (
    plan_prompts, plan_quality, plan_audit, fact_distribution, audit_readiness, audit_samples, release_checks, scene_assembly, clean_openings, first_words, unquoted_texts,
    paragraphs, dialogue_ranked, inferred_attributes, titled_merge, place_mentions, presence_lists, canonical_id_map,
)}
