"""Phrase automata, dyadic range joins, read-only checks, exported numbers and the page layout, against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scenewright.functions import phrases
from scenewright.functions.ranges import dyadic, in_order, range_join
from scenewright.operators import classify, entities
from scenewright.sources import tables

WORDS = ["ab", "abc", "b c", "the king", "king", "kings", "é", "a-b", "don't", "x"]


def texts_of(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["ab", "abc", "b", "c", " ", " ", "-", "'", "the king", "s", "é", "1", "_", ".", "x", "don't"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("pack", [50_000, 3])
def test_phrases(spark, monkeypatch, pack):
    monkeypatch.setattr(phrases, "PACK", pack)
    rows = [(i, t) for i, t in enumerate([*texts_of(1, 300), None, ""])]
    df = spark.createDataFrame(rows, "id int, low string")
    listed = spark.createDataFrame([(w,) for w in [*WORDS, "", "king", None]], "phrase string")

    def holds(text, p, bounds):
        if bounds == "token":
            return p in re.findall(r"[a-z][a-z'-]+", text)
        if bounds == "word":
            return any(phrases.at_words(text, m.start(), m.start() + len(p)) for m in re.finditer(f"(?={re.escape(p)})", text))
        return p in text

    for bounds in phrases.BOUNDS:
        got = {i: set() for i, _ in rows}
        for r in phrases.with_phrases(df, listed, text_col="low", out="found", bounds=bounds).collect():
            assert len(set(r.found)) == len(r.found)
            got[r.id] |= set(r.found)
        assert got == {i: {p for p in WORDS if t and holds(t, p, bounds)} for i, t in rows}
    assert phrases.with_phrases(df, [], text_col="low", out="found").filter("size(found) > 0").count() == 0


def test_a_long_lexicon_costs_no_more_per_text(spark):
    many = [f"phrase number {i}" for i in range(10_000)]
    (automaton,) = phrases.packs(many)
    text = "phrase number 77, and of phrase number 9999."
    assert set(phrases.phrases_in(automaton, text, None)) == {"phrase number 77", "phrase number 7", "phrase number 9", "phrase number 99", "phrase number 999", "phrase number 9999"}
    assert set(phrases.phrases_in(automaton, text, phrases.at_words)) == {"phrase number 77", "phrase number 9999"}


def test_objects_and_labels_by_automaton(spark):
    scenes = spark.createDataFrame([(1, "A Sword, swords and a sword-belt; 'lamp. LAMP"), (2, None), (3, "3sword")], "id int, text string")
    got = {(r.id, r.object) for r in entities.object_mentions(scenes, ["sword", "lamp"], keys=["id"]).collect()}
    assert got == {(1, "Sword"), (1, "Lamp"), (3, "Sword")}
    lexicon = spark.createDataFrame([(1, "place", "sea", "deep  blue", 2), (0, "place", "sea", "wave", 1), (2, "place", "land", "hill", 3), (5, "mood", "calm", "wave", 1)], "position int, dimension string, label string, phrase string, weight int")
    rows = classify.classify_documents(spark.createDataFrame([(1, "Wave on\n wave, uphill")], "document_id int, text string"), lexicon).collect()
    assert sorted((r.dimension, r["rank"], r.label, r.score, tuple(r.evidence)) for r in rows) == [("mood", 1, "calm", 1, ("wave",)), ("place", 1, "land", 3, ("hill",)), ("place", 2, "sea", 1, ("wave",))]
    whole = classify.classify_documents(spark.createDataFrame([(1, "Wave on\n wave, uphill")], "document_id int, text string"), lexicon, word_boundary=True)
    assert {r.label for r in whole.collect()} == {"sea", "calm"}


def test_dyadic_blocks(spark):
    spans = [(a, b) for a in range(-9, 20) for b in range(a, 24)] + [(1, 10_000_000), (123_456_789, 987_654_321)]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", dyadic(F.col("a"), F.col("b")).alias("d")).collect()
    for r in rows:
        assert len(r.d) <= 60
        parts = sorted((x.block << x.level, (x.block + 1 << x.level) - 1) for x in r.d)
        assert parts[0][0] == r.a and parts[-1][1] == r.b and all(y[0] == x[1] + 1 for x, y in zip(parts, parts[1:], strict=False))


def test_range_joins(spark):
    rng = random.Random(4)
    points = [(rng.choice("ab"), rng.randint(1, 90), i) for i in range(200)] + [("c", 5, 900), ("c", 5, 900), ("a", None, 901)]
    spans = [(rng.choice("ab"), s := rng.randint(1, 90), s + rng.choice([0, 0, 3, 40, -2]), f"s{i}") for i in range(60)] + [("a", 1, 10_000_000, "all"), ("b", None, 3, "none")]
    p, s = spark.createDataFrame(points, "k string, n int, i int"), spark.createDataFrame(spans, "k string, lo int, hi int, name string")
    inside = lambda x, y: x[0] == y[0] and x[1] is not None and y[1] is not None and y[1] <= x[1] <= y[2]
    got = sorted((r.i, r.name) for r in range_join(p, s, ["k"], "n", "lo", "hi").collect())
    assert got == sorted((x[2], y[3]) for x in points for y in spans if inside(x, y))
    for how, wanted in (("left_semi", True), ("left_anti", False)):
        found = sorted(r.i for r in range_join(p, s, ["k"], "n", "lo", "hi", how=how).collect())
        assert found == sorted(x[2] for x in points if any(inside(x, y) for y in spans) == wanted)
    assert range_join(p, s.limit(0), ["k"], "n", "lo", "hi").count() == 0 and range_join(p, s.limit(0), ["k"], "n", "lo", "hi", how="left_anti").count() == len(points)


@pytest.mark.parametrize("text, ok", [
    ("SELECT ';' AS x", True), ("  select 1;", True), ("WITH x AS (SELECT 1 AS i) SELECT * FROM x WHERE i IN (SELECT i FROM x)", True), ("VALUES (1)", True),
    ("WITH x AS (SELECT 1 AS i) INSERT INTO t SELECT * FROM x", False), ("SELECT 1; SELECT 2", False), ("DROP TABLE t", False), ("FROM s INSERT INTO t SELECT *", False),
    ("CREATE TABLE t AS SELECT 1", False), ("SELECT reflect('java.lang.System', 'nanoTime')", False), ("selec 1", False), ("SET a = 1", False), ("EXPLAIN SELECT 1", False),
])
def test_only_reading_statements_run(spark, text, ok):
    assert tables.is_read_only(spark, text) == ok
    if not ok:
        with pytest.raises(ValueError):
            tables.read_only_sql(spark, text)


def test_views_of_a_query_do_not_stay(spark):
    spark.range(3).createOrReplaceTempView("kept_view")
    out = tables.read_only_sql(spark, "SELECT (SELECT count(*) FROM kept_view) AS a, (SELECT count(*) FROM own_view) AS b", {"kept_view": spark.range(5), "own_view": spark.range(7)})
    assert tuple(out.first()) == (5, 7)
    assert spark.table("kept_view").count() == 3 and not spark.catalog.tableExists("own_view")


def test_exported_numbers(spark):
    values = [8.0925, 0.0625, 0.1875, 2.5, -1.0005, 64.74, 1e9, 0.0, None, 1234567.8916, 2.0005]
    got = [r.v for r in tables.export_rows(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).collect()]
    assert [float(x) if x else None for x in got] == [None if v is None else round(v, 3) for v in values]


def test_pages_are_bucketed_and_pruned(spark, tmp_path):
    pages = spark.createDataFrame([(f"d{i % 9}", i, f"t{i}") for i in range(300)], "document_id string, page_number int, text string")
    stored = tables.store_pages(pages, "pages_by_document", str(tmp_path / "p"), buckets=8)
    found = tables.scan(stored, {"document_id": "d4"}, pages=(100, 200), order=("page_number",))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # so that the plan shows the buckets it reads
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "SelectedBucketsCount: 1 out of 8" in plan and "GreaterThanOrEqual(page_number,100)" in plan and "LessThanOrEqual(page_number,200)" in plan
    assert [r.page_number for r in found.collect()] == [i for i in range(100, 201) if i % 9 == 4]
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    spark.sql("DROP TABLE pages_by_document")


def test_ranks_and_neighbours_over_stretches(spark):
    """As one window over each whole group gives them: gaps between stretches, ties, null groups and null values."""
    rows = [(g, (i * 7919) % 97 if i % 5 else (i * 7919) % 97 + 900, None if i % 11 == 0 else f"t{i % 6}", i) for g in ("a", "b", None) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, at int, tie string, id int")
    got = in_order(df, ["g"], ["at"], ["tie"], take="id", rank="n", previous="p", following="f", width=10)
    df.createOrReplaceTempView("rows_in_order")
    want = spark.sql("SELECT *, row_number() OVER w AS n, lag(id) OVER w AS p, lead(id) OVER w AS f FROM rows_in_order WINDOW w AS (PARTITION BY g ORDER BY at, tie, id)")
    spark.catalog.dropTempView("rows_in_order")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    two = in_order(df, [], ["at", "id"], take="tie", previous="p", width=16).orderBy("at", "id").collect()
    ties = [r.tie for r in two]
    assert len(two) == len(rows) and two[0].p is None
    # equal (at, id) of the three groups hold equal values, so the one before is the one before in any order
    assert [r.p for r in two][1:] == ties[:-1]
    assert in_order(df.limit(0), ["g"], ["at"], take="id", rank="n").count() == 0


def test_texts_go_to_python_in_bounded_batches(spark):
    from scenewright.functions import phrases

    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "10000")
        spark.conf.set(names[1], str(1 << 30))
        df = phrases.with_phrases(spark.createDataFrame([("a rose",)], "text string"), ["rose"], text_col="text", out="found")
        assert int(spark.conf.get(names[0])) <= phrases.BATCH_ROWS and int(spark.conf.get(names[1])) <= phrases.BATCH_BYTES
        assert df.first().found == ["rose"]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
