"""Literal fixtures of generation plans, audits and scene assembly."""

from pyspark.sql import functions as F

from scenewright.operators import facts, plans

PACKAGE = "scene_id long, title string, text string, names array<string>, moments array<string>, dialogue array<string>, page_start int, page_end int"


def test_good_plans_pass_and_broken_ones_say_why(spark):
    moment = "The captain climbed the burning stairs and looked over the ruined town below."
    made = plans.build_plans(spark.createDataFrame([(1, "Fire", "The town burned.", ["Captain Roe"], [moment], ["Run to the boats now"], 3, 4), (2, None, "  ", ["Who"], [], [], 5, 5)], PACKAGE))
    got = {r.scene_id: r for r in plans.plan_errors(made).collect()}
    assert got[1].errors == [] and got[1].status == "pass" and got[1].direction == "destruction"
    assert got[1].image_prompt.endswith("Dialogue box: Run to the boats now") and len(got[1].short_video.clips) == 3 and len(got[1].long_video.shots) == 4
    assert "plan_not_ready" in got[2].errors and got[2].image_prompt.endswith("Narrative box: Quiet scene.")
    broken = made.filter("scene_id = 1").withColumns({
        "source_grounded": F.lit(False), "image_prompt": F.lit("short"), "short_video": F.struct(F.lit(2).alias("clip_count"), F.slice("short_video.clips", 2, 2).alias("clips")).alias("s"),
        "audio": F.lit(None).cast(made.schema["audio"].dataType), "characters": F.transform("characters", lambda c: F.struct(c["canonical_name"].alias("canonical_name"), F.struct(F.lit("").alias("identity_anchor"), c["visual_profile"]["source_facts"].alias("source_facts"), c["visual_profile"]["inferred_facts"].alias("inferred_facts")).alias("visual_profile"))),
    })
    errors = plans.plan_errors(broken).first().errors
    assert errors == [
        "plan_ungrounded", "image_prompt_short", "image_prompt_layout", "image_prompt_box", "image_prompt_interpretation", "image_prompt_direction", "audio_missing", "no_character_in_prompt",
        "anchor_missing:1", "clip_number:1", "clip_number:2",
    ]
    audited = {r.scene_id: r for r in plans.audit_plans(plans.plan_errors(made)).collect()}
    assert audited[1].issues == ["world_missing"] and audited[2].issues[-1] == "question_word_as_name:Who"
    summary = {(r.kind, r.name): r.n for r in plans.audit_summary(plans.audit_plans(plans.plan_errors(made), world=F.create_map(F.lit("culture"), F.lit("norse")))).collect()}
    assert summary["observation", "narrative_type_missing"] == 2 and ("observation", "culture_missing") not in summary and summary["scene", "pass"] == 1


def test_scene_facts_come_first(spark):
    scenes = spark.createDataFrame([(1, 10), (1, 11)], "document_id int, scene_id int")
    people = spark.createDataFrame([(10, 7, "Roe", ["R"])], "scene_id int, profile_id int, canonical_name string, aliases array<string>")
    told = spark.createDataFrame([(7, None, "appearance", "hair", "red", 0.9), (7, 10, "clothing", "coat", "blue", 0.5), (7, 11, "clothing", "coat", "black", 0.9)], "profile_id int, scene_id int, category string, attribute string, value string, confidence double")
    none = spark.createDataFrame([], "scene_id int, object string, event_order int, text string, entity_id int, status string")
    out = plans.scene_assembly(scenes, characters=people, facts=told, mentions=spark.createDataFrame([(10, 7)] * 3, "scene_id int, profile_id int"), objects=none, events=none, continuity=none, order=["scene_id"])
    first, second = sorted(out.collect(), key=lambda r: r.scene_id)
    assert [f.value for f in first.characters[0].facts] == ["blue", "red"] and first.characters[0].mentions == 3
    assert (first.previous_id, first.next_id, second.previous_id, second.characters, second.events) == (None, 11, 10, [], [])


def test_checks_of_a_release(spark):
    told = spark.createDataFrame([(1, "appearance", "hair", "red", 1, 1, 0.9, "red hair"), (1, "appearance", "hair", "grey", 2, 2, 0.9, "grey hair"), (2, "appearance", "build", "tall", 2, 3, 0.4, "")], "profile_id int, category string, attribute string, value string, scene_id int, fact_id int, confidence double, evidence string")
    known = facts.reconcile_facts(told)
    users = spark.createDataFrame([(1,), (2,), (3,)], "profile_id int")
    some, none = told.select("scene_id"), told.limit(0)
    out = {r.check: (r.value, r.passed) for r in facts.release_checks(profiles=told.select("profile_id").distinct(), canonical=facts.canonical_facts(told), facts=told, classified=facts.classify_conflicts(known), reconciled=known, characters=users, context=some, objects=none, continuity=some, states=some, bad_phrases=["grey hair"]).collect()}
    assert out["canonical_profiles"] == (2, False) and out["canonical_characters"] == (3, False) and out["characters_without_profile"] == (1, False)
    assert out["known_bad_phrase_facts"] == (1, False) and out["object_mentions"] == (0, False) and out["strong_conflicts"] == (0, True)
    ready = facts.readiness(some.distinct(), some.distinct(), told).first()
    assert (ready.context_ok, ready.evidence_ok, ready.confidence_ok, ready.score, ready.status) == (True, False, True, 66.7, "NEEDS_REVIEW")
