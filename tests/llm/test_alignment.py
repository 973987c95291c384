"""Alignment against counting by force with the two libraries, and on odd tables."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from test_operators import table, words

from scenewright.llm import alignment, queries

DATA = "/root/testdata/sf0.001"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def force(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    characters = alignment.byte_level()
    out, links, total = [], [], Counter()
    for i, text in docs:
        want = f" {text or ''}".encode()
        a = first.encode(want.decode(), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(characters[c] for c in first.id_to_token(t)) for t in a]
        bytes_b = [bytes([int(second.id_to_piece(t)[3:5], 16)]) if second.is_byte(t) else second.id_to_piece(t).replace("▁", " ").encode() for t in b]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append([i, 0, 0, 0, 0, ""])
            links.append([])
            continue
        owner_a, owner_b = ([k for k, x in enumerate(found) for _ in x] for found in (bytes_a, bytes_b))
        found = sorted(set(zip(owner_a, owner_b, strict=True)))
        ends = sorted(set(np.cumsum([len(x) for x in bytes_a])) & set(np.cumsum([len(x) for x in bytes_b])))
        groups, at = [], 0
        for e in ends:
            sides = (",".join(str(ids[k]) for k in sorted(set(owner[at:e]))) for ids, owner in ((a, owner_a), (b, owner_b)))
            groups.append("|".join(sides))
            at = e
        links.append([(a[x], b[y]) for x, y in found])
        total.update(links[-1])
        out.append([i, len(a), len(b), len(groups), len(found), hashlib.sha256(";".join(groups).encode()).hexdigest()])
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    return [tuple(row + [sum(total[p] == most[p[1]] for p in found), sum(total[p] for p in found)]) for row, found in zip(out, links, strict=True)], total


def rows_of(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_query_against_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert rows_of(queries.QUERIES["op12_alignment"](spark, DATA)) == sorted(force(docs)[0], key=str)


ODD = [
    (None, None), (1, ""), (None, "no id"), (2, "<|endoftext|> <s> <unk> <0x41> </s>"), (3, "a▁b"), (4, "  two  spaces\t\n\n tab "), (5, "naïve \U0001f600 \x00 日本語 ..."), (6, "x" * 5000 + " " * 900 + "y"),
    (7, "same same same"), (7, "same same same"), ((1 << 60) + 1, "Straße 12,345.67 don't"), (8, "​﻿é"), (9, words(3, 4000)),
]


@pytest.mark.parametrize("docs, held, size", [(65_535, 1 << 22, 1 << 20), (3, 10, 20), (65_535, 50, 4000)])
def test_odd_tables(spark, monkeypatch, docs, held, size):
    for name, value in (("DOCS", docs), ("HELD", held), ("BYTES", size)):
        monkeypatch.setattr(alignment, name, value)
    want, total = force(ODD)
    rows = table(spark, [(i, t, "s") for i, t in ODD])
    assert rows_of(alignment.alignment(rows)) == sorted(want, key=str)
    counts = {(r.a, r.b): (r.links, r.documents) for r in alignment.pair_counts(alignment.index(rows)).collect()}
    assert {p: n for p, (n, _) in counts.items()} == dict(total) and all(1 <= d <= n for n, d in counts.values())
    assert alignment.alignment(table(spark, [])).count() == 0
    assert rows_of(alignment.alignment(table(spark, [(1, None, "s"), (None, "", "s")]))) == [(1, 0, 0, 0, 0, "", 0, 0), (None, 0, 0, 0, 0, "", 0, 0)]


def test_postings_come_back_from_planes():
    rng = np.random.default_rng(4)
    for docs in (1, 9, 700):
        postings = {(int(p) if p < 40 else 7, int(d)): int(n) for p, d, n in zip(rng.integers(0, 80, 4000), rng.integers(0, docs, 4000), rng.zipf(1.6, 4000) % 900 + 1, strict=True)}
        keys = np.array(sorted(p << 16 | d for p, d in postings), np.uint64)
        counts = np.array([postings[int(k) >> 16, int(k) & 0xFFFF] for k in keys])
        made = alignment.packed(keys, counts, docs)
        row, got = {n: v.tobytes() for n, v in made.items()}, Counter()
        for pair, plane, doc in alignment.unpacked(row, docs):
            for p, k, d in zip(made["pairs"][pair].tolist(), plane.tolist(), doc.tolist(), strict=True):
                got[p, d] += 1 << k
        assert got == postings and made["links"].sum() == counts.sum() and made["documents"].sum() == len(keys)
