"""Ids of texts in chunks against whole ones, the packed pieces of the smallest tables, and the risk that the quality classifier minimises."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_operators import table, words

from scenewright.llm import quality, queries, sentencepieces

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@needs_tables
def test_the_scan_gives_the_ids_of_whole_texts(spark):
    """Every text by the scan, in chunks that cut words, against one chunk; with ties: runs of one letter, and words said twice."""
    docs = [(r.doc_id, r.text, "s") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if len(r.text or "") < 4000][:60]
    ties = ["a" * 301, "aa " * 90, "abab" * 80, "the the " * 60, "x.y" * 77, "\t\n" * 50, "é" * 99, words(3, 60)]
    rows = table(spark, docs + [(10_000 + k, t, "s") for k, t in enumerate(ties)])
    ids = {chunk: {r.doc_id: bytes(r.ids) for r in sentencepieces.encode(rows, chunk=chunk).collect()} for chunk in (37, 1 << 20)}
    assert ids[37] == ids[1 << 20] and len(ids[37]) == len(docs) + len(ties)


@needs_tables
def test_packing_query(spark):
    """Pieces cover each document's ids once, in order, and sequences are gapless, full but for little, and at most 2048 long."""
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    ids = {i: np.array([*model.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op9_packing"](spark, DATA).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == docs.keys()
    for i, found in pieces.items():
        ends = np.cumsum([n for _, n in sorted(found)])
        assert [s for s, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] == len(ids[i])
    for found in sequences.values():
        ends = np.cumsum([n for _, n in sorted(found)])
        assert [o for o, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(map(len, ids.values())) > 0.97 * 2048 * len(sequences)


def risk(w, positive, unlabelled, prior, penalty=1e-4):
    """Positives' share of being taken for positive, and the rest of the unlabelled risk, at least nothing; plainly."""
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    p, u = sigmoid(positive @ w), sigmoid(unlabelled @ w)
    rest = np.mean([-np.log(1 - x) for x in u]) - prior * np.mean([-np.log(1 - x) for x in p])
    return prior * np.mean([-np.log(x) for x in p]) + max(0.0, rest) + penalty / 2 * (w @ w)


def test_the_quality_classifier_minimises_its_risk():
    rng = np.random.default_rng(6)
    good, bad = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1.5, (700, 3))
    unlabelled = np.concatenate([rng.normal(1, 1, (300, 3)), bad])
    centre, spread, w = quality.fit(good, unlabelled, 0.3)
    p, u = quality.expanded(good, centre, spread), quality.expanded(unlabelled, centre, spread)
    found = risk(w, p, u, 0.3)
    assert found < risk(np.zeros_like(w), p, u, 0.3)
    worse = sum(risk(w + rng.normal(0, 0.1, len(w)), p, u, 0.3) >= found - 1e-3 for _ in range(40))
    assert worse >= 38
