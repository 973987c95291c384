import pytest
from pyspark.sql import functions as F

from scenewright.operators import entities, identity, retrieval


def test_extraction(spark):
    scenes = spark.createDataFrame([("b", 1, 1, "Captain Nemo spoke. John walked toward the River Thames. They entered the dark cave.")], "document_id string, story_order int, scene_order int, text string")
    got = {(r.entity_type, r.canonical_name) for r in entities.extract_mentions(scenes).collect()}
    assert ("character", "Captain Nemo") in got and ("character", "John") in got
    assert any(t == "location" and n == "River Thames" for t, n in got) and any(t == "environment" and "cave" in n for t, n in got)
    assert ("character", "River Thames") not in got


ENTITY = "document_id string, entity_id long, entity_type string, canonical_name string, profile_text string, confidence double"
MENTION = "document_id string, entity_id long, scene_id long, scene_order int, context string, confidence double"


def test_titled_merge(spark):
    known = spark.createDataFrame([("b", 1, "character", "Professor Lidenbrock", "", 0.8), ("b", 2, "character", "Lidenbrock", "", 0.75), ("b", 3, "location", "River Thames", "", 0.6), ("b", 4, "location", "River Tames", "", 0.6), ("b", 5, "location", "river thames", "", 0.5)], ENTITY)
    said = spark.createDataFrame([("b", 1, 1, 1, "c1", 0.8), ("b", 2, 2, 2, "c2", 0.75), ("b", 5, 2, 2, "c3", 0.5)], MENTION)
    kept, moved, aliases = entities.resolve_entities(known, said)
    assert sorted(r.canonical_name for r in kept.collect()) == ["Professor Lidenbrock", "River Tames", "River Thames"]
    assert sorted(r.entity_id for r in moved.collect()) == [1, 1, 3]
    assert {(r.alias, r.method) for r in aliases.filter("entity_id = 1").collect()} == {("Professor Lidenbrock", "source_spelling"), ("Lidenbrock", "titled_name_variant")}


@pytest.mark.parametrize("name, types, context, decision, reason", [
    ("Aruna", "location", "Aruna said, 'We must go.'", ("validated", "probable"), "direct_person_reference"),
    ("Mithila", "location", "The road to Mithila was long.", ("non_character",), "ambiguous_name_without_person_evidence"),
    ("Mithila", "location", "Lord Shiva said, 'We must travel to Mithila.'", ("non_character",), "ambiguous_name_without_person_evidence"),
    ("Who", None, None, ("non_character",), "common_word_or_demographic_term"),
])
def test_gate(spark, name, types, context, decision, reason):
    rows = [("b", 1, "character", name, "", 0.5)] + ([("b", 2, types, name, "", 0.5)] if types else [])
    said = spark.createDataFrame([("b", 1, 1, 1, context, 0.5)] if context else [], MENTION)
    got = identity.candidate_gate(spark.createDataFrame(rows, ENTITY), said).filter("entity_id = 1").first()
    assert got.decision in decision and reason in got.reasons
    if name == "Aruna":
        assert got.score >= 0.48 and "name_also_classified_as_location_or_environment" in got.reasons


def test_evidence_labels(spark):
    known = spark.createDataFrame([("b", 1, "character", "Captain Nemo", "", 0.8), ("b", 2, "location", "Paris", "", 0.6), ("b", 3, "character", "Axel", "", 0.6)], ENTITY)
    said = spark.createDataFrame([("b", 1, i, i, "Captain Nemo said he walked away.", 0.8) for i in range(5)], MENTION)
    got = {r.entity_id: r.label for r in identity.classify_evidence(known, said).collect()}
    assert got == {1: "validated", 2: "non_character", 3: "reference"}


@pytest.mark.parametrize("a, b, ok, confidence, method", [
    ("Lord Shiva", "Lord Shiva Pasupathi", True, 0.88, "qualified_identity_variant"), ("Lord Shiva", "Lord Shiva Pasupathi Literally", True, 0.88, "qualified_identity_variant"),
    ("Lord Shiva", "Lord Vishnu", False, 0.0, "no_safe_identity_match"), ("Otto Lidenbrock", "Lidenbrock", True, 0.82, "surname_variant"),
    ("Professor Otto Lidenbrock", "Otto Lidenbrock", True, 0.98, "normalized_exact"), ("John Smith", "Jack Smith", True, 0.86, "same_surname_initial_variant"),
    ("Mary Smith", "John Smith", False, 0.0, "same_surname_but_different_given_name"), ("Orange River", "River", False, 0.0, "semantic_non_person_block"),
])
def test_compatible(spark, a, b, ok, confidence, method):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(identity.compatible(F.col("a"), F.col("b")).alias("c")).first().c
    assert (got.ok, got.confidence, got.method) == (ok, confidence, method)


def test_groups_to_characters(spark):
    names = ["Otto Lidenbrock", "Lidenbrock", "Lord Shiva", "Lord Shiva Pasupathi", "Axel", "Karl Lidenbrock"]
    gate = spark.createDataFrame([("b", i, "character", n, "validated" if i == 0 else "probable", 0.8) for i, n in enumerate(names)], "document_id string, entity_id long, entity_type string, canonical_name string, decision string, score double")
    groups, members = identity.identity_groups(gate)
    got = {r.group_id: r.member_ids for r in groups.collect()}
    assert got == {0: [0, 1], 2: [2, 3], 4: [4], 5: [5]}  # first fit, and a member is never compared as a root
    evidence = identity.identity_evidence(groups, members)
    assert {r.group_id: r.relationship for r in evidence.collect()} == {0: "identity_alias", 2: "identity_alias"}
    assert {r.relationship for r in identity.identity_evidence(groups, members, strict=True).collect()} == {"unresolved"}
    resolved = identity.resolve_groups(groups, members)
    people = identity.canonical_characters(groups, members, resolved, gate)
    assert {r.group_id: r.status for r in people.collect()} == {0: "confirmed", 2: "confirmed", 4: "singleton", 5: "singleton"}
    kinds = {(r.group_id, r.entity_id): r.relationship for r in identity.canonical_aliases(people, members).collect()}
    assert kinds[0, 0] == "canonical" and kinds[0, 1] == "alias"
    said = spark.createDataFrame([("b", 0, 7, 7, "", 0.5), ("b", 1, 7, 7, "", 0.5)], MENTION)
    assert {r.group_id: r.relationship for r in identity.resolve_groups(groups, members, method="scene_overlap", mentions=said).collect()}[0] == "likely_alias"


def test_retrieval(spark):
    kinds = ["page", "section", "story", "scene", "entity", "event", "chunk"]
    text = {"scene": "Professor Lidenbrock spoke", "entity": "A man of science"}
    rag = retrieval.rag_documents({k: spark.createDataFrame([("1", k, "character: Professor Lidenbrock" if k == "entity" else k, text.get(k, "other words"))], "document_id string, source_id string, title string, text string") for k in kinds})
    assert rag.count() == 7 and rag.select("rag_id").distinct().count() == 7
    posted = retrieval.postings(rag)
    asked = spark.createDataFrame([(1, "Professor Lidenbrock")], "query_id long, text string")
    hits = {r.rag_id for r in retrieval.search(posted, retrieval.doc_stats(rag), asked).collect()}
    assert hits == {"1:entity:entity", "1:scene:scene"}
    only = retrieval.search(posted, retrieval.doc_stats(rag), asked, rag=rag, source_type="entity").collect()
    assert [r.rag_id for r in only] == ["1:entity:entity"]
    assert {r.rag_id for r in retrieval.phrase_matches(rag, asked).collect()} == hits


def test_objects(spark):
    scenes = spark.createDataFrame([(1, "He took the Lantern and a map. The lantern shone."), (2, "Nothing.")], "scene_id long, text string")
    assert sorted(r.object for r in entities.object_mentions(scenes, keys=["scene_id"]).collect()) == ["Lantern", "Map"]


def test_ids_of_titled_parts_never_meet(spark, tmp_path):
    """Part keys a million apart: the noun of one had the id of the other."""
    from scenewright.plans import details

    part = [(1, "red rose", 1), (1_000_001, "blue lily", 2), (2_000_001, "green fern", 3)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    item = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double"
    spark.createDataFrame([(1, k, n, 1.0, 0.1) for k, _, _ in part for n in (1, 2, 3)], item).write.parquet(str(tmp_path / "lineitem.parquet"))
    known = details.titled_parts(spark, str(tmp_path))[0]
    assert known.select("entity_id").distinct().count() == known.count() == 9
    assert sum(r.n for r in details.moved_mentions(spark, str(tmp_path)).collect()) == 9
