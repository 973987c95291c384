"""Generation plans: scene context assembly, prompts of every medium, plan rules and the audit of a package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import in_order
from .packages import direction, quality_errors

#: Style of coverage by class of a scene.
STYLES = {
    "destruction": "wide shot through smoke and ruin", "combat": "fast, close coverage", "travel": "tracking shot along the way",
    "dialogue": "over-the-shoulder exchange", "characters": "medium shot of those present", "default": "establishing shot",
}
#: Sizes of shots, in turn.
SHOTS = ["establishing", "wide", "medium", "close", "detail", "closing"]
#: Names that are question words and no characters.
NOT_NAMES = ["who", "what", "when", "where", "which", "why", "this", "that", "these", "those"]


def scene_assembly(scenes: DataFrame, *, characters: DataFrame, facts: DataFrame, mentions: DataFrame, objects: DataFrame, events: DataFrame, continuity: DataFrame, order: list[str]) -> DataFrame:
    """One row per scene (document_id, scene_id, ...): characters with their facts and mentions, objects, events, continuity and neighbours.

    Facts of the scene itself come before lasting ones (scene_id null), then higher confidence
    first. characters: scene_id, profile_id, canonical_name, aliases. Child tables are nested
    before they meet the scenes, so nothing multiplies.
    """
    rank = F.struct((-F.col("confidence")).alias("less"), "category", "attribute", "value")
    held = F.transform(F.array_sort(F.collect_set(rank)), lambda x: F.struct(x["category"].alias("category"), x["attribute"].alias("attribute"), x["value"].alias("value"), (-x["less"]).alias("confidence")))
    # lasting facts are gathered once for a profile, not once for each of its scenes
    own = facts.filter("scene_id IS NOT NULL").groupBy("scene_id", "profile_id").agg(held.alias("__own"))
    lasting = facts.filter("scene_id IS NULL").groupBy("profile_id").agg(held.alias("__lasting"))
    none = F.array().cast(own.schema["__own"].dataType)
    told = F.concat(F.coalesce("__own", none), F.when(F.col("scene_id").isNotNull(), F.coalesce("__lasting", none)).otherwise(none))
    seen = mentions.groupBy("scene_id", "profile_id").agg(F.count(F.lit(1)).alias("mentions"))
    keys = ["scene_id", "profile_id"]
    people = characters.join(own, keys, "left").join(lasting, "profile_id", "left").join(seen, keys, "left").withColumns({"facts": told, "mentions": F.coalesce("mentions", F.lit(0))})
    # neighbours are found before anything nested is beside the scenes
    out = in_order(scenes, ["document_id"], order, take="scene_id", previous="previous_id", following="next_id")
    for name, rows, fields in (("characters", people, ["canonical_name", "profile_id", "aliases", "facts", "mentions"]), ("objects", objects, ["object"]), ("events", events, ["event_order", "text"]), ("continuity", continuity, ["entity_id", "status"])):
        nested = rows.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        out = out.join(nested, "scene_id", "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
    return out.select(*[c for c in out.columns if c not in ("previous_id", "next_id")], "previous_id", "next_id")


def build_plans(packages: DataFrame, *, clips: int = 3, mobile: str = "9:16") -> DataFrame:
    """packages (scene_id, title, text, names, moments, dialogue, page_start, page_end) with a plan for image, short and long video and sound.

    The focus of clip or shot i is moment i modulo their number; at most 2 lines of dialogue
    are laid over the image, else one narrative box. What is not known stays unknown.
    """
    n = F.greatest(F.size("moments"), F.lit(1))
    focus = lambda i: F.coalesce(F.try_element_at("moments", (i % n + 1).cast("int")), F.lit("Quiet scene."))
    kind = direction(F.col("text"), F.size("dialogue") > 0, F.size("names") > 0)
    style = F.create_map(*[F.lit(x) for pair in STYLES.items() for x in pair])[F.col("direction")]
    names = F.when(F.size("names") > 0, F.array_join(F.slice("names", 1, 6), ", ")).otherwise("none named")
    grounded = F.concat(F.lit(" Characters: "), names, F.lit(". Source-grounded; unknown details stay unknown."))
    moving = lambda what, i: F.concat(F.lit(what), (i + 1).cast("string"), F.lit(f", {mobile}. Source-anchored scene interpretation: "), focus(i), F.lit(" Cinematic direction: "), style, F.lit("."), grounded)
    boxes = F.when(F.size("dialogue") > 0, F.slice("dialogue", 1, 2)).otherwise(F.array(focus(F.lit(0))))
    image = F.concat(
        F.lit(f"Source-grounded image, {mobile}. PRIMARY SOURCE VISUAL MOMENT: "), focus(F.lit(0)), F.lit(" Source-anchored scene interpretation of "), F.coalesce("title", F.lit("an untitled scene")),
        F.lit(", pages "), F.col("page_start").cast("string"), F.lit(" to "), F.col("page_end").cast("string"), F.lit(". DETECTED STORY WORLD: as the source tells. Cinematic direction: "), style, F.lit("."), grounded,
        F.when(F.size("dialogue") > 0, " Dialogue box: ").otherwise(" Narrative box: "), F.array_join(boxes, " / "),
    )
    shots = F.least(F.lit(len(SHOTS)), F.greatest(F.lit(4), F.size("moments")))
    size = F.array(*[F.lit(s) for s in SHOTS])
    profile = lambda name: F.struct(F.concat(F.lit("vib-"), F.substring(F.sha2(name, 256), 1, 12)).alias("identity_anchor"), F.array().cast("array<string>").alias("source_facts"), F.array().cast("array<string>").alias("inferred_facts"))
    made = packages.withColumn("direction", kind).withColumns({"image_prompt": image, "__boxes": boxes})
    return made.withColumns({
        "plan_status": F.when(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0, "ready").otherwise("empty"), "source_grounded": F.lit(True), "unknowns_must_remain_unknown": F.lit(True),
        "characters": F.transform("names", lambda x: F.struct(x.alias("canonical_name"), profile(x).alias("visual_profile"))),
        "short_video": F.struct(F.lit(clips).alias("clip_count"), F.transform(F.sequence(F.lit(0), F.lit(clips - 1)), lambda i: F.struct((i + 1).alias("clip_number"), moving("Clip ", i).alias("prompt"))).alias("clips")),
        "long_video": F.struct(F.transform(F.sequence(F.lit(0), shots - 1), lambda i: F.struct((i + 1).alias("shot_number"), F.concat(F.get(size, i), F.lit(" shot. "), moving("Shot ", i)).alias("prompt"))).alias("shots")),
        "audio": F.struct(F.array(F.concat(F.lit("Music for a scene of "), "direction")).alias("music_direction"), F.concat(F.lit("Sounds of: "), focus(F.lit(0))).alias("sound_design")),
        "media": F.struct(
            F.lit(True).alias("source_grounded"),
            F.struct(F.struct(F.lit(mobile).alias("aspect_ratio"), F.lit(1).alias("dialogue_box_count_minimum")).alias("layout"), F.col("__boxes").alias("dialogue_overlays")).alias("image"),
            F.struct(F.lit(True).alias("enabled")).alias("visual_inference"),
        ),
        "source_evidence": F.slice("moments", 1, 5),
    }).drop("__boxes")


def _needs(*phrases: str) -> str:
    return "coalesce(image_prompt, '') <> '' AND NOT (" + " OR ".join(f"contains(lower(image_prompt), '{p}')" for p in phrases) + ")"


_BOX = "media.image.layout IS NOT NULL AND "
#: (error, condition under which a plan has it)
PLAN_RULES = [
    ("plan_not_ready", "coalesce(plan_status, '') <> 'ready'"), ("plan_ungrounded", "NOT coalesce(source_grounded, false)"), ("unknowns_not_kept", "NOT coalesce(unknowns_must_remain_unknown, false)"),
    ("image_prompt_short", "length(trim(coalesce(image_prompt, ''))) < 240"), ("image_prompt_ungrounded", "length(trim(coalesce(image_prompt, ''))) >= 240 AND NOT contains(lower(image_prompt), 'source-grounded')"),
    ("image_prompt_layout", _needs("9:16")), ("image_prompt_box", _needs("dialogue", "narrative box")), ("image_prompt_interpretation", _needs("source-anchored scene interpretation")), ("image_prompt_direction", _needs("cinematic direction")),
    ("characters_missing", "characters IS NULL"), ("media_missing", "media IS NULL"), ("media_ungrounded", "media IS NOT NULL AND NOT coalesce(media.source_grounded, false)"), ("image_package_missing", "media.image IS NULL"),
    ("layout_missing", "media.image IS NOT NULL AND media.image.layout IS NULL"), ("layout_ratio", _BOX + "coalesce(media.image.layout.aspect_ratio, '') <> '9:16'"),
    ("box_missing", _BOX + "greatest(coalesce(media.image.layout.dialogue_box_count_minimum, 0), size(coalesce(media.image.dialogue_overlays, array()))) < 1"), ("overlay_missing", _BOX + "size(coalesce(media.image.dialogue_overlays, array())) = 0"),
    ("short_video_missing", "short_video IS NULL"), ("clips_missing", "short_video IS NOT NULL AND size(coalesce(short_video.clips, array())) = 0"), ("clip_count", "size(short_video.clips) > 0 AND NOT (short_video.clip_count <=> size(short_video.clips))"),
    ("long_video_missing", "long_video IS NULL"), ("shots_missing", "long_video IS NOT NULL AND size(coalesce(long_video.shots, array())) = 0"),
    ("audio_missing", "audio IS NULL"), ("music_short", "audio IS NOT NULL AND NOT exists(coalesce(audio.music_direction, array()), m -> length(trim(m)) >= 20)"), ("sound_short", "audio IS NOT NULL AND length(trim(coalesce(audio.sound_design, ''))) < 20"),
    ("inference_missing", "media.visual_inference IS NULL"), ("evidence_missing", "source_evidence IS NULL"),
    ("no_character_in_prompt", "size(characters) > 0 AND length(trim(coalesce(image_prompt, ''))) > 0 AND NOT exists(characters, c -> contains(lower(image_prompt), lower(c.canonical_name)))"),
]
#: (list, error, condition on its element x at place i) of which the first that holds counts for an element.
PART_RULES = [
    ("characters", [("character_invalid", "x IS NULL"), ("profile_missing", "x.visual_profile IS NULL"), ("anchor_missing", "coalesce(x.visual_profile.identity_anchor, '') = ''"), ("provenance_missing", "x.visual_profile.source_facts IS NULL OR x.visual_profile.inferred_facts IS NULL")]),
    ("short_video.clips", [("clip_prompt_short", "length(trim(coalesce(x.prompt, ''))) < 160"), ("clip_number", "NOT (x.clip_number <=> i + 1)"), ("clip_interpretation", "NOT contains(lower(x.prompt), 'source-anchored scene interpretation')")]),
    ("long_video.shots", [("shot_prompt_short", "length(trim(coalesce(x.prompt, ''))) < 160"), ("shot_number", "NOT (x.shot_number <=> i + 1)"), ("shot_interpretation", "NOT contains(lower(x.prompt), 'source-anchored scene interpretation')")]),
]


def plan_errors(plans: DataFrame) -> DataFrame:
    """plans with errors (of the plan, then of its numbered parts, as name:number) and status."""
    checked = quality_errors(plans, PLAN_RULES)
    parts = []
    for where, rules in PART_RULES:
        cases = " ".join(f"WHEN coalesce({c}, false) THEN concat('{name}:', i + 1)" for name, c in rules)
        parts.append(F.expr(f"filter(transform(coalesce({where}, array()), (x, i) -> CASE {cases} END), e -> e IS NOT NULL)"))
    every = F.concat("errors", *parts)
    return checked.withColumn("errors", every).withColumn("status", F.when(F.size("errors") == 0, "pass").otherwise("fail"))


def audit_plans(checked: DataFrame, *, world: Column | None = None) -> DataFrame:
    """checked plans (plan_errors) with issues, and the observations whose world dimensions are missing.

    world: map of dimension to its leading label, where there is one.
    """
    names = F.transform("characters", lambda c: c["canonical_name"])
    odd = F.transform(F.filter(names, lambda n: F.lower(n).isin(NOT_NAMES)), lambda n: F.concat(F.lit("question_word_as_name:"), n))
    bare = F.transform(F.filter("characters", lambda c: F.coalesce(c["visual_profile"]["identity_anchor"], F.lit("")) == ""), lambda c: F.concat(F.lit("anchor_missing:"), c["canonical_name"]))
    prompt = F.coalesce("image_prompt", F.lit(""))
    plain = F.array_compact(F.array(
        F.when(F.col("status") != "pass", "plan_rules_failed"), F.when(F.lit(world is None) if world is None else world.isNull(), "world_missing"), F.when(prompt == "", "image_prompt_missing"),
        F.when(~F.contains(prompt, F.lit("PRIMARY SOURCE VISUAL MOMENT:")), "primary_moment_missing"), F.when(~F.contains(prompt, F.lit("DETECTED STORY WORLD")), "world_missing_in_prompt"),
        F.when(~F.coalesce(F.col("media.visual_inference.enabled"), F.lit(False)), "inference_invalid"),
    ))
    dimensions = ["narrative_type", "culture", "religious_context"]
    seen = F.array_compact(F.array(*[F.when((F.lit(None).cast("string") if world is None else F.try_element_at(world, F.lit(d))).isNull(), F.lit(f"{d}_missing")) for d in dimensions]))
    return checked.withColumn("issues", F.concat(plain, odd, bare)).withColumn("observations", seen)


def audit_summary(audited: DataFrame) -> DataFrame:
    """kind, name, n: counts of issues and observations, and of scenes that fail and pass."""
    issue = F.transform("issues", lambda x: F.struct(F.lit("issue").alias("kind"), F.split(x, ":")[0].alias("name")))
    seen = F.transform("observations", lambda x: F.struct(F.lit("observation").alias("kind"), x.alias("name")))
    state = F.array(F.struct(F.lit("scene").alias("kind"), F.when(F.size("issues") == 0, "pass").otherwise("fail").alias("name")))
    return audited.select(F.explode(F.concat(issue, seen, state)).alias("r")).groupBy("r.kind", "r.name").agg(F.count(F.lit(1)).alias("n"))
