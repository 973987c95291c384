"""Collocations against counting by force, and on odd tables."""

import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_operators import table

from scenewright.llm import collocations, common, queries

DATA = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def force(docs, least, share, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans(common.UPPER, common.LOWER))
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = tuple(x for x in re.split("[ \t]", piece) if x)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, w[i : i + k]] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, p), a in candidates.items():
        if len(p) == 3:
            for q in (p[:2], p[1:]):
                inside[lang, q] = max(inside[lang, q], a)
    rows = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) in inside and 100 * inside[lang, p] >= share * a:
            continue
        score, _, left, right = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        rows[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in rows.items() for k, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def invented(seed, n):
    rng = np.random.default_rng(seed)
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]
    return "".join(f"{'W' if rng.random() < 0.1 else 'w'}{rng.zipf(1.5) % 60}{ends[rng.integers(0, 8)]}" for _ in range(n))


@pytest.mark.parametrize("shard, held, block", [(1 << 16, 1 << 21, 1 << 20), (40, 500, 64)])
def test_against_force(spark, monkeypatch, shard, held, block):
    for name, value in (("SHARD", shard), ("PACK", 3 * shard), ("HELD", held), ("JOINED", held), ("BLOCK", block)):
        monkeypatch.setattr(collocations, name, value)
    docs = [("en" if k % 3 else None, invented(k, 150)) for k in range(60)] + [("en", None), ("fr", ""), ("de", "…".join(["Äb c"] * 30))]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    for least, share, top in ((10, 50, 2000), (3, 90, 25)):
        want = force(docs, least, share, top)
        assert len({r[0] for r in want}) > 1 and rows_of(collocations.collocations(df, least=least, share=share, top=top)) == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_query_and_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    docs = con.sql("SELECT lang, text FROM documents").fetchall()
    want = force(docs, 10, 50, 2000)
    assert want and sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({collocations.ORACLE})").fetchall()) == want
    assert rows_of(queries.QUERIES["op11_collocations"](spark, DATA)) == want


def test_odd_tables(spark):
    same = [(k, "Same words here. same words here; SAME words\tthere", "s") for k in range(8)]
    rows = [(None, None, None), (1, "", "a"), (2, "!!! \n", "a"), (3, "x" * 3_000_000 + " y", "a"), (4, "ab cd " * 40_000, "b"), *same, *same]
    got = rows_of(collocations.collocations(table(spark, rows)))
    assert got == force([("en", t) for _, t, _ in rows], 10, 50, 2000)
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(1, None, "a"), (2, "one", "b")])).count() == 0


def test_words_that_share_a_symbol_are_told_apart(spark, monkeypatch):
    drawn = collocations.byte_table
    monkeypatch.setattr(collocations, "byte_table", lambda seed: np.zeros(256, np.uint64) if seed == 0 else drawn(seed))
    docs = [("en", "ab cd. ba dc. " * 12)]
    assert rows_of(collocations.collocations(spark.createDataFrame(docs, "lang string, text string"))) == force(docs, 10, 50, 2000)


def test_tries_hold_what_they_were_built_from():
    rng = np.random.default_rng(2)
    symbols = rng.integers(1, 1 << 64, 300, dtype=np.uint64)
    rows = {(a, b, c) for a, b, c in rng.integers(0, 300, (4000, 3)).tolist()} | {(0, b, c) for b in range(40) for c in range(40)} | {(a, 1, None) for a in range(200)}
    phrases = np.array([[symbols[a], symbols[b], symbols[c] if c is not None else 0] for a, b, c in sorted(rows, key=str)], np.uint64)
    trie = collocations.build_trie(phrases)
    text = np.concatenate([np.concatenate([phrases[:, 0:2].ravel(), rng.choice(symbols, 5000)]), phrases[phrases[:, 2] > 0].ravel()])
    want = {2: Counter(), 3: Counter()}
    place = {tuple(p): k for k, p in enumerate(phrases.tolist())}
    for i in range(len(text) - 2):
        for k, p in ((2, (*text[i : i + 2].tolist(), 0)), (3, tuple(text[i : i + 3].tolist()))):
            if p in place:
                want[k][place[p]] += 1
    for k in (2, 3):
        assert Counter(collocations.accepted(trie, text, np.arange(len(text) - 2), k).tolist()) == want[k]


def test_one_pass_over_the_texts_for_all_packs(spark, monkeypatch):
    """Phrases of many packs of tries are counted in one pass, and what tasks counted is summed up piece by piece."""
    for name, value in (("SHARD", 20), ("PACK", 40), ("MERGED", 50), ("BUCKETS", 8), ("HELD", 700), ("PLACES", 3)):
        monkeypatch.setattr(collocations, name, value)
    collocations.placed_tables.cache_clear()
    passes, counting = [], collocations.count_phrases

    def counted(seed, packs, shards):
        passes.append(len(packs))
        return counting(seed, packs, shards)

    monkeypatch.setattr(collocations, "count_phrases", counted)
    docs = [("en" if k % 3 else None, invented(k, 150)) for k in range(60)]
    got = rows_of(collocations.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(3)))
    collocations.placed_tables.cache_clear()
    assert got == force(docs, 10, 50, 2000) and len(passes) == 1 and passes[0] > 2


def test_phrases_that_share_a_hash_are_summed_apart(monkeypatch):
    monkeypatch.setattr(collocations, "pair_hash", lambda a, b: np.zeros(len(a), np.uint64))
    a, b = np.array([5, 6, 5, 6, 5, 7], np.uint64), np.array([1, 1, 1, 1, 2, 1], np.uint64)
    parcel = collocations.parcels(a * 0, [a, b, np.array([3, 1, 2, 9, 4, 5], np.int32)])
    (found,) = collocations.merged_phrases(2, 5)(iter([parcel, parcel.slice(0, 0)]))
    assert sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)) == [(5, 1), (6, 1), (7, 1)]
