from pyspark.sql import functions as F

from scenewright.operators import entities, packages
from scenewright.plans import books


def test_names_come_with_their_contexts(spark):
    said = spark.createDataFrame([(1, "Ann", "Ann walked on"), (1, "Bob", "old Bob"), (2, "Cid", "no Cid"), (2, "Dora", None)], "s int, canonical_name string, context string")
    told = spark.createDataFrame([(2, "CID was there."), (3, "Eve ran.")], "s int, text string")
    assert {tuple(r) for r in packages.presence(None, told, said, keys=["s"]).collect()} == {(1, "Ann", True), (1, "Bob", False), (2, "Cid", True), (2, "Dora", False)}
    apart = packages.presence(said.select("s", "canonical_name"), told, said.select("s", "context"), keys=["s"])
    assert {tuple(r) for r in apart.collect()} == {tuple(r) for r in packages.presence(None, told, said, keys=["s"]).collect()}


def test_contexts_are_cut_as_by_the_built_in_functions(spark):
    from scenewright.functions.text import context_window

    texts = ["İn the ÖDE Öde was. " * 30 + "Then  Anna Bell planned; Anna", " \t Bell Ångström 😀 " + "x" * 500 + " Bell", "Only Once" + " y" * 300, None, "", "none"]
    scenes = spark.createDataFrame([(i, "b", t) for i, t in enumerate(texts)], "scene_order int, document_id string, text string")
    rows = entities.extract_mentions(scenes, books.NAME_RULE).join(scenes, ["scene_order", "document_id"])
    found = rows.select("context", context_window(F.col("text"), F.col("canonical_name")).alias("expected")).collect()
    assert len(found) >= 5 and all(r.context == r.expected for r in found)


def test_counting_names_cuts_no_contexts(spark):
    scenes = spark.createDataFrame([(1, "b", "Anna met Bell")], "scene_order int, document_id string, text string")
    bare = entities.extract_mentions(scenes, books.NAME_RULE, contexts=False)
    assert "context" not in bare.columns and "Python" not in bare._jdf.queryExecution().executedPlan().toString()
    assert {r.canonical_name for r in bare.collect()} == {r.canonical_name for r in entities.extract_mentions(scenes, books.NAME_RULE).collect()}


def test_the_lively_pattern_finds_what_both_lists_find(spark):
    words = [w.replace(r"\w*", "") for w in packages._WORDS]
    texts = [t for w in words for t in (w, w.upper(), f"x{w}", f"{w}ing", f"{w}s", f"é{w}", f"{w}é", f"({w})", w[:-1], f"a {w}_")] + ["", "ſit", "looK", "nobody", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = packages.has("t", packages.L.ACTION) | packages.has("t", packages.L.PRESENCE)
    assert df.filter(~packages.has("t", packages.LIVELY).eqNullSafe(both)).count() == 0
    assert not any(w.startswith("(") for w in words) and len(words) > 50


def test_moments_and_directions_by_one_pattern(spark):
    lists = {"TELLING": ((packages.SPEECH, packages.L.ACTION, packages.L.DESTRUCTION, packages.L.COMBAT, packages.L.REACTION), "(?U)"), "MOVING": ((packages.L.DESTRUCTION, packages.L.COMBAT, packages.L.TRAVEL), "")}
    for name, (patterns, flags) in lists.items():
        words = [w.replace(r"\w*", "") for p in patterns for w in packages._listed(p)]
        texts = [t for w in words for t in (w, w.upper(), f"x{w}", f"{w}s", f"é{w}", f"{w}é", f"({w})", w[:-1], f"a {w}_")] + ["", "ſit", "looK", "nobody", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        every = F.lit(False)
        for p in patterns:
            every = every | F.col("t").rlike(flags + p)
        assert df.filter(~F.col("t").rlike(flags + getattr(packages, name)).eqNullSafe(every)).count() == 0
    said = packages.direction(F.col("t"), F.lit(False), F.lit(False))
    df = spark.createDataFrame([("They left in smoke",), ("she ran and fought",), ("She RAN.",), ("quiet",), (None,)], "t string")
    assert [r[0] for r in df.select(said).collect()] == ["destruction", "combat", "travel", "default", "default"]


def test_only_the_first_moments_of_a_row_are_moved(spark):
    text = " ".join(f"The quiet lake number {i} lay still." for i in range(30)) + " He walked to the fire there. They said it was all fine. They asked whom to follow there."
    scenes = spark.createDataFrame([(1, text), (1, "The old men fought with anger. " + text), (2, None), (3, "too short.")], "s int, text string")
    got = packages.moments(scenes, keys=["s"], k=4)
    assert [(r.moment, r.score, r.rank) for r in got.orderBy("s", "rank").collect()] == [
        ("He walked to the fire there.", 72, 1), ("They asked whom to follow there.", 60, 2), ("The old men fought with anger.", 18, 3), ("The quiet lake number 0 lay still.", 10, 4)]
    assert "slice(" in got._jdf.queryExecution().executedPlan().toString()
    named = packages.moments(scenes, names=spark.createDataFrame([(1, "Number 29")], "s int, canonical_name string"), keys=["s"], k=3)
    assert ("The quiet lake number 29 lay still.", 22) in {(r.moment, r.score) for r in named.collect()}
