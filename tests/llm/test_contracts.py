"""The queries themselves on the smallest tables, large ids beside nulls, rewritten shards, moved records and the stages of the pipeline, against brute force."""

import hashlib
import itertools
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import components_by_force, low, removed_by_force, table, words

import corpus_pipeline
from scenewright.llm import fixity, media, near_dedup, packing, queries, repeats, sentencepieces, sharding, toxicity

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
LARGE = [(1 << 60) + 1, (1 << 60) + 3, None]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()


def test_large_ids_beside_a_null(spark):
    rows = table(spark, [(i, words(40 + k, 30), "s") for k, i in enumerate(LARGE)])
    model = toxicity.constant(0.5)
    for out in (
        toxicity.scored(rows, model), repeats.trimmed(repeats.with_spans(rows)), media.text_to_media(rows), near_dedup.near_duplicates(rows), sentencepieces.encode(rows), sentencepieces.encode(rows, chunk=20, digests=True), packing.pack(packing.tokenised(rows)),
    ):
        assert {r.doc_id for r in out.select("doc_id").collect()} == set(LARGE)


@needs_tables
@pytest.mark.parametrize("name, parts, remainder", [("op1_toxicity", 4, 2), ("op4_quality", 5, 0)])
def test_scores(spark, docs, name, parts, remainder):
    got = queries.QUERIES[name](spark, DATA).collect()
    assert Counter(r.doc_id for r in got) == Counter(d.doc_id for d in docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == remainder)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


@needs_tables
def test_repeats_query(spark, docs):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op2_suffix_dedup"](spark, DATA).collect())
    assert got == sorted(removed_by_force([(d.doc_id, d.text) for d in docs], 400))


@needs_tables
def test_media_query(spark, docs):
    """The stored form is parsed by hand here: the payload is the body of the mdat box."""
    got = {r.doc_id: r for r in queries.QUERIES["op3_media_columns"](spark, DATA).collect()}
    for d in docs:
        raw = (d.text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        stored = media.write_container(media.payload_of(d.text)[1])
        at, bodies = 0, {}
        while at < len(stored):
            size = int.from_bytes(stored[at : at + 4], "big")
            bodies[stored[at + 4 : at + 8]] = stored[at + 8 : at + size]
            at += size
        r = got[d.doc_id]
        assert bodies[b"mdat"] == payload and r.media_sha256 == hashlib.sha256(stored).hexdigest()
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored))


@needs_tables
def test_near_query(spark, docs):
    want = components_by_force([(d.doc_id, d.text) for d in docs])
    got = queries.QUERIES["op5_near_dedup"](spark, DATA).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and all(r.kept == (r.doc_id == r.component_id) for r in got)


@needs_tables
def test_sharding_query(spark, docs):
    got = queries.QUERIES["op7_sharding"](spark, DATA).collect()
    text = {d.doc_id: (d.text or "").encode() for d in docs}
    assert len(got) == len(docs) and all((r.size, r.text_crc32, r.law) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "rows") for r in got)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 16
    assert all(sorted(r.slot for r in got if r.shard == j) == list(range(counts[j])) for j in range(16))


def test_moves_cost_the_least(spark):
    """Against all ways to deal up to seven rows to three shards."""
    rng = np.random.default_rng(11)
    for _ in range(25):
        n = int(rng.integers(3, 8))
        old, size = rng.integers(0, 3, n), rng.integers(1, 50, n)
        blocks = {}
        for o in range(3):
            for c, s in enumerate(sorted(set(size[old == o]))):
                blocks[o, c] = (int((size[old == o] == s).sum()), int(s * (size[old == o] == s).sum()))
        room = [n // 3 + (j < n % 3) for j in range(3)]
        segments = sharding.plan_moves(blocks, room)
        cost = sum((hi - lo) * blocks[o, c][1] / blocks[o, c][0] for o, c, lo, hi, j in segments if j != o)
        assert Counter({j: sum(hi - lo for *_, lo, hi, k in segments if k == j) for j in range(3)}) == Counter(dict(enumerate(room)))
        best = min(sum(s for o, s, j in zip(old, size, way, strict=True) if o != j) for way in itertools.product(range(3), repeat=n) if [way.count(j) for j in range(3)] == room)
        assert abs(cost - best) < 1e-6


def test_rewriting_keeps_every_row(spark, tmp_path):
    rows = [(None if i % 5 == 0 else i // 2, f"text {i // 4}", f"s{i % 4}") for i in range(40)] + [(7, "twice", "s1")] * 3
    docs = table(spark, rows)
    old = F.pmod(F.regexp_replace("source", "s", "").cast("int"), F.lit(4))
    path = str(tmp_path / "shards")
    docs.select("doc_id", "text", F.lit(0).cast("long").alias("slot"), old.alias("shard")).write.partitionBy("shard").parquet(path)
    plan = sharding.plan_reshard(docs, old_shard=old, shards=4)
    placed = sharding.reshard(docs, old_shard=old, shards=4, carry=True, plan=plan)
    assert plan.touched() == sharding.affected(placed)
    # rows of shards 0 and 1 only change places with each other
    swapped = placed.withColumn("shard", F.when(F.col("old_shard") == 0, 1).when(F.col("old_shard") == 1, 0).otherwise(F.col("old_shard")))
    before = Counter((r.doc_id, r.text, r.shard) for r in spark.read.parquet(path).select("doc_id", "text", "shard").collect())
    assert sharding.rewrite_affected(swapped, path) == [0, 1]
    after = Counter((r.doc_id, r.text, r.shard) for r in spark.read.parquet(path).select("doc_id", "text", "shard").collect())
    assert after == Counter({(i, t, {0: 1, 1: 0}.get(s, s)): n for (i, t, s), n in before.items()})


def test_moved_records_are_found(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "b" * (i % 50)) for i in range(200)], "page_id long, url string, html string")
    kept = fixity.records(pages, file_bytes=9000).cache()
    last = kept.agg(F.max("file")).first()[0]
    shifted = kept.withColumn("offset", F.col("offset") + F.when(F.col("file") == last, 7).otherwise(0))
    found = fixity.audit(kept, shifted).collect()
    assert {r.status for r in found} == {"moved"} and {r.file for r in found} == {last} and len(found) == kept.filter(F.col("file") == last).count()
    assert fixity.replica_root(kept).first() != fixity.replica_root(shifted).first()
    one = fixity.records(pages, file_bytes=1 << 30)
    assert fixity.audit(one, one.filter("place <> 3")).select("status").first().status == "missing"


@needs_tables
def test_sentencepiece_query(spark, docs):
    pieces = sentencepieces.Pieces()
    got = {r.doc_id: r for r in queries.QUERIES["op8_sentencepiece"](spark, DATA).collect()}
    for d in docs:
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    for d in sorted(docs, key=lambda d: len(d.text or ""))[:60]:
        s = sentencepieces.SPACE + d.text.replace(" ", sentencepieces.SPACE)
        ids = np.array(pieces.between(s, 0, len(s))[0], "<u4")
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@needs_tables
def test_stages_against_brute_force(spark, docs):
    found = {}
    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, DATA)
        assert name == "packing" or out.columns == rows.columns
        found[name] = [tuple(r) for r in out.select(*(("doc_id", "text") if name != "packing" else ("doc_id", "length", "sequence_id"))).collect()]
        if name != "packing":
            rows = spark.createDataFrame(out.collect(), out.schema)
    assert set(found["quality"]) <= {tuple(d) for d in docs} and len(found["quality"]) > len(docs) // 2
    last = {}
    for i, t in found["quality"]:
        last[low(t)] = max(last.get(low(t), -1), i)
    assert sorted(i for i, _ in found["exact_dedup"]) == sorted(last.values())
    five = lambda t: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := low(t).split()) else frozenset()
    sets, kept = [(i, five(t)) for i, t in sorted(found["exact_dedup"])], {}
    for i, s in sets:
        kept[i] = i
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((kept[i], kept[j]))
            kept = {k: x if v == y else v for k, v in kept.items()}
    assert sorted(i for i, _ in found["near_dedup"]) == sorted(i for i, v in kept.items() if i == v)
    cut = {i: (n, gone) for i, n, gone, *_ in removed_by_force(found["near_dedup"], 400)}
    assert all(0 <= len(t.encode()) - (cut[i][0] - cut[i][1]) <= 12 for i, t in found["suffix_dedup"])
    assert {i for i, *_ in found["packing"]} == {i for i, _ in found["suffix_dedup"]}
    used = Counter()
    for _, length, sequence in found["packing"]:
        used[sequence] += length
    assert max(used.values()) <= 2048


@needs_tables
def test_stages_on_odd_tables(spark):
    rows = table(spark, [(None, None, None), (None, "no id " * 40, "a"), (1, "", "a"), (2, words(3, 60), "b"), (2, words(3, 60), "b"), (LARGE[0], words(4, 90), None)])
    for name, stage in corpus_pipeline.STAGES:
        for given in (rows, rows.limit(0)):
            out = stage(spark, given, DATA)
            assert name == "packing" or out.columns == given.columns
            assert (out.count() > 0) == (given is rows) or name == "quality"


@needs_tables
def test_stages_keep_columns_named_like_their_own(spark):
    """Extra columns come out with their values, whatever they are called."""
    names = ["__score", "__SCORE_", "__sha", "__n", "__key", "__found", "__spans", "__gone", "__kept_id", "__kept_sha", "registers", "digest", "a.b", "node", "label"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, rows, DATA)
        assert out.columns == rows.columns
        got = out.select("doc_id", *[F.col(f"`{n}`") for n in names]).collect()
        assert got and all(r[n] == f"{n}:{r.doc_id}" for r in got for n in names), name
    with pytest.raises(ValueError):
        repeats.with_spans(rows)
