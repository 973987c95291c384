"""SimHash classes against all pairs, and on odd tables."""

import os

import numpy as np
import pytest
import xxhash
from test_operators import low, table, words

from scenewright.llm import common, queries, simhash
from scenewright.llm.components import components

DATA = "/root/testdata/sf0.001"


def force(text):
    w = low(text).split()
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """id -> least id that can be reached over links of at most two bits, all pairs compared."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: force(d.text) for d in docs}
    component = classes(list(want.items()))
    got = queries.QUERIES["op13_simhash"](spark, DATA).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", component[i]) for i, p in want.items()}


@pytest.mark.parametrize("bucket", [2, 16])
def test_links_of_families(spark, monkeypatch, bucket):
    """Chains and dense families whose variants are shared by few and by many fingerprints."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(3)
    prints = {0, 3, (1 << 64) - 1, (1 << 63), (1 << 63) | 1}
    for _ in range(6):
        seed = int(rng.integers(0, 1 << 63)) * 2 + 1
        now = seed
        for _ in range(40):  # a walk of up to three bits: some steps are no links
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                now ^= 1 << int(b)
            prints.add(now)
        prints |= {seed ^ 1 << int(b) for b in rng.choice(64, 30, replace=False)}
        prints |= {seed ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (60, 3))}
    rows = [(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(sorted(prints))]
    pairs = simhash.links(spark.createDataFrame(rows, "fp long, node long"))
    unsigned = {k: p % (1 << 64) for p, k in rows}
    assert all((unsigned[r.a] ^ unsigned[r.b]).bit_count() <= 2 for r in pairs.collect())
    got = {r.node: r.component for r in components(pairs).collect()}
    assert {k: got.get(k, k) for k in unsigned} == classes(list(unsigned.items()))


def test_odd_tables(spark):
    rows = [(None, None, None), (None, "no id here at all", "a"), (9, None, "a"), (4, "", "a"), (5, " \t\n", "a"), (7, "One two", None), (6, "one\x0btwo", "b"), (7, "One two", "b"), (8, words(1, 9000), "b"), (3, words(1, 9000).upper(), "b"), ((1 << 60) + 1, "ÀB c d é", "b")]
    got = [tuple(r) for r in simhash.near_duplicates(table(spark, rows)).collect()]
    want = classes([(i, force(t)) for i, t, _ in rows if i is not None])
    assert sorted(map(str, got)) == sorted(str((i, f"{force(t):016x}", want.get(i), i is None or want[i] == i)) for i, t, _ in rows)
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_long_texts_in_blocks(monkeypatch):
    texts = [words(5, 400), "", words(6, 3), words(7, 90), words(8, 1)]
    whole = simhash.majorities([simhash.shingle_hashes(t) for t in texts])
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert list(simhash.majorities([simhash.shingle_hashes(t) for t in texts])) == list(whole)
    assert [int(x) % (1 << 64) for x in whole] == [force(t) for t in texts]


def test_variants_are_not_broadcast(spark, monkeypatch):
    """A table of fingerprints below Spark's broadcast limit has 64 times as many variants, which Spark does not see."""
    plans, saved = {}, common.saved

    def seen(df, name, **more):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return saved(df, name, **more)

    monkeypatch.setattr(common, "saved", seen)
    nodes = saved(spark.range(2000).selectExpr("xxhash64(id) AS fp", "id AS node"), "nodes")
    simhash.links(nodes).count()
    assert "SortMergeJoin" in plans["simhash-variants"] and "Broadcast" not in plans["simhash-variants"]
