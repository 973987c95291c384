import datetime as dt
import random

from pyspark.sql import functions as F

from scenewright.operators import continuity, index
from scenewright.streaming import streams

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def files(spark, path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{k}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def drained(spark, df, path):
    df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def test_state_changes(spark, tmp_path):
    schema = "user long, ts timestamp, kind string"
    stream = files(spark, str(tmp_path / "in"), [[(1, at(0), "a"), (2, at(1), "x"), (1, at(2), "a")], [(1, at(3), "b"), (2, at(4), "x")]], schema)
    got = drained(spark, streams.state_changes(stream, entity="user", order="ts", value="kind"), str(tmp_path))
    assert sorted((r.entity, r.new, r.change_type) for r in got.collect()) == [(1, "a", "introduced"), (1, "b", "updated"), (2, "x", "introduced")]


PAGE = "document_id string, page_number int, raw_text string, at timestamp"


def test_pages_are_ingested_once(spark, tmp_path):
    stream = files(spark, str(tmp_path / "in"), [[("a", 1, "one\ntwo", at(0))], [("a", 1, "again", at(1)), ("b", 1, "word", at(2))], [("a", 2, "more", at(3))]], PAGE)
    pages = streams.ingest_pages(stream).drop("at")
    query = streams.write_pages(pages, str(tmp_path / "pages"), str(tmp_path / "state"))
    query.processAllAvailable()
    query.stop()
    got = streams.current_pages(spark, str(tmp_path / "pages"), pages.schema)
    # the page of an earlier batch stays when another page of its document comes
    assert sorted((r.document_id, r.page_number, r.text) for r in got.collect()) == [("a", 1, "one two"), ("a", 2, "more"), ("b", 1, "word")]


def test_versions_of_documents(spark, tmp_path):
    """Replayed, broken off and split batches, against a dictionary."""
    schema, path = "document_id string, page_number int, text string", str(tmp_path / "store")
    batches = [[("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], [("a", 2, "new"), ("c", 1, "c")], [("b", 1, "z2"), ("b", 1, "z3")]]
    want = {}
    for version, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, schema)
        assert streams.merge_pages(batch, path, version) == len({r[0] for r in rows})
        want |= {(d, p): t for d, p, t in sorted(rows)}
        assert streams.merge_pages(batch, path, version) == 0  # replayed
        if version == 1:  # broken off before its manifest was whole: written again
            (tmp_path / "store" / "manifest" / "1" / "_SUCCESS").unlink()
            assert streams.merge_pages(batch, path, version) == 2
        got = streams.current_pages(spark, path, schema).collect()
        assert {(r.document_id, r.page_number): r.text for r in got} == want and len(got) == len(want)
    assert {r.document_id for r in streams.changed_documents(spark, path, 0).collect()} == {"a", "b", "c"}
    assert {r.document_id for r in streams.changed_documents(spark, path, 1).collect()} == {"b"}


def test_an_index_keeps_in_step(spark, tmp_path):
    first = spark.createDataFrame([("a:page:1", "", "old words")], "rag_id string, title string, text string")
    index.build_index(first, str(tmp_path / "i"), ranges=4)
    stream = files(spark, str(tmp_path / "in"), [[("a", 1, "fresh words", at(0))], [("b", 1, "other words", at(2))]], PAGE)
    query = streams.write_pages(streams.ingest_pages(stream).drop("at"), str(tmp_path / "pages"), str(tmp_path / "state"), index=str(tmp_path / "i"))
    query.processAllAvailable()
    query.stop()
    asked = spark.createDataFrame([(1, "words"), (2, "old"), (3, "fresh")], "query_id int, text string")
    hits = {(r.query_id, r.id) for r in index.search_index(index.open_index(spark, str(tmp_path / "i")), asked).collect()}
    assert hits == {(1, "a:page:1"), (1, "b:page:1"), (3, "a:page:1")}


def test_attribute_changes_equal_the_batch_form(spark, tmp_path):
    """Four buckets, several values, removals, sightings without facts, rows out of order and sightings split between batches."""
    rng = random.Random(7)
    rows = []
    for minute in range(60):
        who = rng.choice([1, 2, 3])
        told = [(who, at(minute), minute, rng.choice(["appearance", "clothing", "injury", "objects"]), rng.choice(["a", "b"]), rng.choice("xyz")) for _ in range(rng.randint(0, 4))]
        rows += told or [(who, at(minute), minute, None, None, None)]
    schema = "user long, ts timestamp, scene long, bucket string, attribute string, value string"
    mixed = sorted(rows, key=lambda r: (r[2] // 8, rng.random()))
    batches = [mixed[:40], mixed[40:75], mixed[75:], [(9, at(500), 500, None, None, None)]]
    stream = files(spark, str(tmp_path / "in"), batches, schema)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKS)
    changes = drained(spark, streams.attribute_changes(stream, entity="user", order="ts", scene="scene", late="60 minutes"), str(tmp_path))
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = changes.collect()
    df = spark.createDataFrame(rows, schema).withColumn("confidence", F.lit(0.5)).withColumnRenamed("user", "entity_id").withColumnRenamed("scene", "scene_id")
    want = continuity.state_changes(continuity.entity_states(df, df.filter("attribute IS NOT NULL"))).collect()
    shown = lambda r, scene: (r[0], scene, r.attribute, tuple(r.previous or ()), tuple(r.new or ()), r.change_type)
    assert sorted(shown(r, r.scene) for r in got if not r.first and r.change_type != "carried") == sorted(shown(r, r.scene_id) for r in want)
    assert {r.change_type for r in got} == {"introduced", "carried", "updated", "removed"}


def test_sessions(spark, tmp_path):
    rows = [(1, at(0)), (1, at(4)), (1, at(12)), (2, at(3)), (1, at(40))]
    stream = files(spark, str(tmp_path / "in"), [rows[:3], rows[3:], [(3, at(300))], [(3, at(301))], [(2, at(5))]], "user long, ts timestamp")
    got = drained(spark, streams.session_counts(stream, event_time="ts", gap="5 minutes", key="user", late="60 minutes"), str(tmp_path))
    # the row at minute 5 of user 2 came after the watermark had passed it
    assert sorted((r.user, r.start, r.stop, r.n) for r in got.collect()) == [(1, at(0), at(9), 2), (1, at(12), at(17), 1), (1, at(40), at(45), 1), (2, at(3), at(8), 1)]


def test_status_counts(spark, tmp_path):
    schema = "ts timestamp, status string"
    stream = files(spark, str(tmp_path / "in"), [[(at(1), "ok"), (at(2), "ok"), (at(3), "bad")], [(at(200), "ok")]], schema)
    got = drained(spark, streams.status_counts(stream, event_time="ts", period="10 minutes"), str(tmp_path))
    assert sorted((r.status, r.n) for r in got.collect()) == [("bad", 1), ("ok", 2)]


def test_stale_jobs(spark, tmp_path):
    schema = "job_id long, updated_at timestamp, status string"
    stream = files(spark, str(tmp_path / "in"), [[(1, at(0), "running"), (2, at(0), "running")], [(2, at(5), "done"), (3, at(200), "running")], [(3, at(201), "running")]], schema)
    got = drained(spark, streams.stale_jobs(stream, minutes=30), str(tmp_path))
    assert [r.job for r in got.collect()] == [1]
