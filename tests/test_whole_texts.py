"""Patterns asked of whole texts first, facts gathered once, and what is moved: results as if each context were asked by itself."""

from pyspark.sql import functions as F

from scenewright.operators import entities, identity, plans
from scenewright.streaming import streams


def test_words_that_a_cut_makes_are_found(spark):
    text = "aforesaid he went. Élan thesaid x, then she herself 'd say nothing; himself́ shed"
    cuts = [(a, b) for a in range(len(text)) for b in range(a + 1, len(text) + 1)]
    rows = spark.createDataFrame([(text[a:b].strip(" "), text) for a, b in cuts], "context string, text string")
    for pattern in (identity.DIALOGUE, identity.HUMAN_ACTION, identity.PRONOUN):
        got = rows.filter(identity.within(F.col("context"), pattern, F.col("text").rlike(pattern)) != F.col("context").rlike(pattern))
        assert got.isEmpty()
    bare = rows.filter(identity.within(F.col("context"), identity.DIALOGUE, F.lit(False)) != F.col("context").rlike(identity.DIALOGUE))
    assert rows.filter(F.col("text").rlike(identity.DIALOGUE)).isEmpty() and bare.isEmpty()  # only cuts make "said" a word


def test_flags_change_no_evidence(spark):
    known = spark.createDataFrame([(1, 1, "character", n) for n in ()] or [(1, i, "character", n) for i, n in enumerate(["Ana", "Ana Ana", "Élan", "Kit"])], "document_id int, entity_id long, entity_type string, canonical_name string")
    texts = ["Xana Ana Ana said so", "he ran. Anan", "élan, she", "Kit said", "Kıt and he", "Ana\u0001 Kit", "said Kit. Mr. Ana"]
    said = known.select("document_id", "entity_id", "canonical_name").crossJoin(spark.createDataFrame(list(enumerate(texts)), "scene_id long, context string"))
    for step in (identity.candidate_gate, identity.classify_evidence):
        plain = step(known, said).drop("evidence").orderBy("entity_id").collect()
        assert step(known, said.withColumns(identity.text_signs(F.col("context")))).drop("evidence").orderBy("entity_id").collect() == plain
    hits = {r.entity_id: r for r in identity.classify_evidence(known, said).select("entity_id", F.size("evidence").alias("n")).collect()}
    assert hits[1].n == 1 and hits[3].n == 3  # an overlapping hit counts; signs that fold to the name's letters count


def test_contexts_are_not_moved_for_labels(spark):
    known = spark.createDataFrame([(1, 1, "character", "Ana")], "document_id int, entity_id long, entity_type string, canonical_name string")
    said = spark.createDataFrame([(1, 1, 1, "Ana said so")], "document_id int, entity_id long, scene_id long, context string").withColumn("canonical_name", F.lit("Ana"))
    plan = identity.classify_evidence(known, said).select("entity_id", "label", "reasons")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_profiles_of_null_documents_and_ties(spark):
    rows = [(None, "character", "Ana", 0.4, i, f"c{i % 3}") for i in range(9)] + [(1, "character", "Ana", 0.5, 1, "b"), (1, "character", "Ana", 0.5, 1, "a")]
    said = spark.createDataFrame(rows, "document_id int, entity_type string, canonical_name string, confidence double, scene_order int, context string").repartition(4)
    got = {r.document_id: r for r in entities.entities(said, order=["scene_order"]).collect()}
    assert got[None].mention_count == 9 and got[None].profile_text == "c0\n\nc1\n\nc2\n\nc0\n\nc1" and got[1].profile_text == "a\n\nb"


def test_lasting_facts_meet_profiles_once(spark):
    scenes = spark.createDataFrame([(1, i) for i in range(3)], "document_id int, scene_id long")
    there = spark.createDataFrame([(i, 7, "n", []) for i in range(3)], "scene_id long, profile_id long, canonical_name string, aliases array<string>")
    told = spark.createDataFrame([(7, None, "a", "hair", "red", 0.5), (7, None, "a", "hair", "red", 0.5), (7, 1, "a", "build", "tall", 0.3), (7, 9, "a", "build", "old", 0.3)], "profile_id long, scene_id long, category string, attribute string, value string, confidence double")
    none = spark.createDataFrame([], "scene_id long, object string, event_order long, text string, entity_id long, status string, profile_id long")
    out = plans.scene_assembly(scenes, characters=there, facts=told, mentions=none.select("scene_id", "profile_id"), objects=none.select("scene_id", "object"), events=none.select("scene_id", "event_order", "text"), continuity=none.select("scene_id", "entity_id", "status"), order=["scene_id"])
    got = {r.scene_id: [f.value for f in r.characters[0].facts] for r in out.collect()}
    assert got == {0: ["red"], 1: ["tall", "red"], 2: ["red"]}


class _State:
    """A map or value that counts how often it is asked."""

    def __init__(self):
        self.held, self.asked = {}, 0

    def iterator(self):
        self.asked += 1
        return iter([((k,), (v,)) for k, v in self.held.items()])

    def updateValue(self, key, value):
        self.held[key[0]] = value[0]

    def removeKey(self, key):
        del self.held[key[0]]

    def exists(self):
        return False

    def update(self, value):
        pass

    def getCurrentWatermarkInMs(self):
        return 1000


def test_state_is_read_once_for_all_sightings():
    step = streams._Changes()
    step.values, step.waiting = _State(), _State()
    fresh = [[i, i, "s.a", "xyz"[i // 2 % 3]] for i in range(10)] + [[10, 10, "s.b", "u"]]
    (out,) = step.settle((1,), fresh, _State())
    assert step.values.asked == 1 and step.values.held == {"s.b": ["u"]}
    assert list(out["change_type"])[:4] == ["introduced", "carried", "updated", "carried"] and list(out["change_type"])[-2:] == ["removed", "introduced"]
