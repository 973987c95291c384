"""Each operator against a brute-force version, a round trip or held-out accuracy, and on odd tables."""

import hashlib
import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scenewright.llm import common, exact_dedup, fixity, media, near_dedup, packing, quality, repeats, sentencepieces, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, component_id long, spans string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), True, 1.0, 7, "x", "y") for i, t, s in rows], SCHEMA)


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, copies, repeated rows, clashing column names."""
    long = words(1, 9000)
    rows = [(1, None, None), (2, "", "a"), (None, "no id", "a"), (3, "Tie", "a"), (4, "tIE", None), (5, long, "b"), (6, long, "b"), (7, "same row", "c"), (7, "same row", "c"), (8, "   \n\t ", "c"), (9, "Straße ÀÉ \U0001f600 \x00 end", "d"), (10, words(2, 300), "d"), (11, words(2, 300) + " tail", "d")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def low(t):
    return (t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def test_exact(spark, odd, empty):
    got = exact_dedup.exact_dedup(odd).collect()
    texts = [r.text for r in odd.collect()]
    sizes = Counter(low(t) for t in texts)
    assert len(got) == len(texts) and sum(r.kept for r in got) == len(sizes)
    assert Counter(r.text_sha256 for r in got) == Counter(hashlib.sha256(low(t)).hexdigest() for t in texts)
    tie = {r.doc_id: r for r in got if r.doc_id in (3, 4)}
    assert tie[3].keep_id == tie[4].keep_id == 4 and not tie[3].kept and tie[4].kept
    kept = exact_dedup.keep_first_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(sizes)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_first_copies(empty).count() == 0


def test_exact_with_few_heavy_digests(spark):
    docs = table(spark, [(i, f"t{i % 40}" if i % 3 else "hot", "s") for i in range(600)])
    got = exact_dedup.exact_dedup(docs, heavy=2, tracked=8).collect()
    best, size = {}, Counter()
    for r in docs.collect():
        best[r.text], size[r.text] = max(best.get(r.text, -1), r.doc_id), size[r.text] + 1
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.keep_id, r.group_size, r.kept) == (best[text[r.doc_id]], size[text[r.doc_id]], best[text[r.doc_id]] == r.doc_id) for r in got)


def sets_of(text):
    w = low(text).split()
    return frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def components_by_force(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, sets_of(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and find(i) != find(j):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def test_near(spark, odd, empty, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):
        base = words(100 + g, int(rng.integers(3, 160))).split()
        for _ in range(int(rng.integers(1, 14))):
            w = list(base)
            for _ in range(int(rng.integers(0, 6))):
                w[int(rng.integers(0, len(w)))] = f"new{rng.integers(9)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "two words"), (len(rows) + 3, "TWO  words")]
    docs = table(spark, [(i, t, "s") for i, t in rows])
    want = components_by_force(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == want
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == want
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count() and {r.doc_id: r.component_id for r in got}[11] == 10
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.keep_one_of_each(odd).columns == odd.columns


def test_near_links_behind_a_pair_of_unlike_sizes(spark):
    """b is a link of a (80 of 100 shingles) and of c (79 of 80), but a and c are no plausible pair."""
    rows = []
    for g in range(48):
        base = words(2000 + g, 103).split()
        texts = [" ".join(base[:n]) for n in (103, 83, 82)]
        order = list(itertools.permutations(range(3)))[g % 6]
        rows += [(3 * g + k, texts[order[k]]) for k in range(3)]
    docs = table(spark, [(i, t, "s") for i, t in rows])
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: i - i % 3 for i, _ in rows}


def test_stage_of_near_copies_takes_five_words(spark):
    """44 words, one of them changed: 37 of 45 strings of four words, 35 of 45 of five."""
    base = words(3000, 44).split()
    docs = table(spark, [(1, " ".join(base), "s"), (2, " ".join([*base[:20], "other", *base[21:]]), "s")])
    assert near_dedup.keep_one_of_each(docs).count() == 1
    assert corpus_pipeline.near_copies(spark, docs, "").count() == 2


def test_likelihood_and_merging():
    rng = np.random.default_rng(3)
    universe = rng.integers(1, 1 << 62, 3000).astype(np.uint64)
    a, b = universe[:2000], universe[200:2200]
    ra, rb = (near_dedup.registers(x, np.array([0]))[0] for x in (a, b))
    both = near_dedup.registers(np.union1d(a, b), np.array([0]))[0]
    assert (np.maximum(ra, rb) == both).all()
    got = near_dedup.estimated(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([(ra == rb).sum()]), np.array([2000.0]), np.array([2000.0]))
    assert abs(got[0] - 1800 / 2200) < 0.12


def removed_by_force(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        covered = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                covered[k : k + length] = True
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((i, len(b), int(covered.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~covered])).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [1000, 2])
def test_repeats(spark, odd, empty, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    shared, other = words(50, 90), words(51, 70)
    rows = [(i, words(200 + i, 30 + i) + " " + (shared[i : 420 + 13 * i] if i % 2 else other) + " " + words(300 + i, 20)) for i in range(20)]
    rows += [(20, "orre " * 300), (21, shared), (22, "é" * 500), (23, None), (24, "x" * 399), (25, "x" * 399), (26, words(7, 40) + shared + words(8, 9) + shared)]
    docs = table(spark, [(i, t, "s") for i, t in rows])
    run = lambda d: sorted(map(tuple, repeats.trimmed(repeats.with_spans(d)).collect()), key=str)
    assert run(docs) == removed_by_force(rows, 400)
    assert run(odd) == removed_by_force([(r.doc_id, r.text) for r in odd.collect()], 400)
    assert run(empty) == []
    cut = repeats.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert set(cut.filter("doc_id = 22").first().text) <= {"é"}


def test_sharding(spark, odd, empty):
    rng = np.random.default_rng(1)
    docs = table(spark, [(i, "x" * int(rng.integers(0, 400)), f"s{i % 5 if i % 3 else 0}") for i in range(500)])
    for df in (docs, odd):
        got = sharding.reshard(df, old_shard=F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(16))).collect()
        assert len(got) == df.count()
        counts = Counter(r.shard for r in got)
        every = [counts[j] for j in range(16)]
        assert max(every) - min(every) <= 1
        for j in range(16):
            assert sorted(r.slot for r in got if r.shard == j) == list(range(counts[j]))
        assert Counter((r.size, r.text_crc32) for r in got) == Counter((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert sharding.reshard(empty, old_shard=F.lit(0)).count() == 0


def test_fewest_bytes_move():
    blocks = {(0, 0): (6, 60), (0, 1): (4, 4000), (1, 0): (2, 20)}
    plan = sharding.plan_moves(blocks, [4, 4, 4])
    moved = sum((hi - lo) * blocks[o, c][1] / blocks[o, c][0] for o, c, lo, hi, j in plan if o != j)
    assert sum(hi - lo for *_, lo, hi, _ in plan) == 12 and moved == 60
    filled = Counter()
    for _, _, lo, hi, j in plan:
        filled[j] += hi - lo
    assert filled == {0: 4, 1: 4, 2: 4}


def test_media_round_trip():
    for n in (0, 1, 64, 4096, 4097, 70_000):
        size, payload = media.payload_of("a" * n)
        data = media.write_container(payload)
        found = media.describe(data)
        assert size == n and len(payload) % 64 == 0 and len(payload) >= 64
        assert media.sample_bytes(data, found["track"]) == payload
        assert (found["codec"], found["duration"], found["n_keyframes"]) == ("raw ", len(payload), -(-len(payload) // 4096))
        first = found["keyframes"][-1]
        assert data[first["start"] : first["start"] + first["size"]] == payload[(found["n_keyframes"] - 1) * 4096 :][:64]
    for bad in (None, b"", b"junk", data[:50], data[:-9], data[:-1] + b"", b"\0\0\0\1moov" + b"\xff" * 8):
        assert media.describe(bad)["error"]


def test_compact_sizes_and_fragments():
    data = media.write_container(bytes(range(128)) * 2)
    whole = media.describe(data)
    at = data.index(b"stsz") - 4
    old = data[at : at + int.from_bytes(data[at : at + 4], "big")]
    n = int.from_bytes(old[16:20], "big")
    for bits, body in ((8, bytes([64] * n)), (16, b"\0\x40" * n)):
        new = media.full(b"stz2", 0, 0, bytes([0, 0, 0, bits]), n.to_bytes(4, "big"), body)
        sizes = {}
        for kind in (b"stbl", b"minf", b"mdia", b"trak", b"moov"):
            k = data.index(kind) - 4
            sizes[k] = int.from_bytes(data[k : k + 4], "big") + len(new) - len(old)
        made = bytearray(data)
        for k, size in sizes.items():
            made[k : k + 4] = size.to_bytes(4, "big")
        made = bytes(made).replace(old, new)
        got = media.describe(made)
        assert (got["n_samples"], got["error"]) == (whole["n_samples"], None) and media.sample_bytes(made, got["track"]) == bytes(range(128)) * 2
    assert "fragments" in media.describe(data + media.box(b"moof"))["error"]


def test_media_columns(spark, odd, empty):
    stored = media.text_to_media(odd)
    rows = media.media_columns(stored, id_col="doc_id", bytes_col="media").collect()
    assert len(rows) == odd.count() and all(r.error is None and r.codec == "raw " for r in rows)
    broken = media.media_columns(spark.createDataFrame([(1, b"xx"), (2, None)], "id long, data binary"), id_col="id", bytes_col="data").collect()
    assert all(r.error and r.codec is None for r in broken)
    digest = F.pandas_udf(media.digests, media.DIGESTS)
    got = stored.filter("doc_id = 9").select(digest("media").alias("d")).select("d.*").first()
    payload = media.payload_of([r.text for r in odd.collect() if r.doc_id == 9][0])[1]
    assert got.payload_sha256 == hashlib.sha256(payload).hexdigest() and got.tail_crc32 == zlib.crc32(payload[-64:])
    assert media.text_to_media(empty).select(digest("media").alias("d")).count() == 0


def pieces_are_whole(rows, got, window=2048):
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    for i, ids in rows.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return by_sequence


def test_packing(spark, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(2)
    texts = [words(400 + i, int(rng.integers(0, 900))) for i in range(60)] + [None, "", "It's ЖÀ İstanbul. a.b, x! <|endoftext|> 12 don't\x0bnow\x1fhere　wide"]
    docs = table(spark, [(i, t, "s") for i, t in enumerate(texts)])
    ids = {i: [*model.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    sequences = pieces_are_whole(ids, packing.pack_documents(docs).collect())
    total = sum(map(len, ids.values()))
    assert len(sequences) <= -(-total // 2048) + 2
    assert packing.pack_documents(odd).agg(F.sum("length")).first()[0] == sum(len(model.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("h", [{700: 1000}, {2047: 5, 1: 3}, {1024: 7, 512: 4, 100: 9}, {k: k % 7 for k in range(1, 2048)}, {}])
def test_plans_use_every_document(h):
    hist = np.zeros(2048, np.int64)
    for k, n in h.items():
        hist[k] = n
    rows, sequences = packing.plan(hist)
    used = np.zeros(2048, np.int64)
    for r, lo, hi, *_ in rows:
        assert lo == used[r]
        used[r] += hi - lo
    assert (used == hist).all()
    assert sequences * 2048 - (hist * np.arange(2048)).sum() <= 2048 + 12 * sequences


def test_sentencepieces_find_the_best_path():
    p = sentencepieces.Pieces()
    text = "The quick brown fox, naïve café \U0001f600 ends\nhere  now"

    def force(s):
        best = [0.0] + [float("-inf")] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - p.longest), j):
                if s[i:j] in p.known:
                    best[j] = max(best[j], best[i] + p.known[s[i:j]][1])
            if s[j - 1] not in p.known:
                best[j] = max(best[j], best[j - 1] + p.unknown)
        return best[-1]

    s = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
    assert p.between(s, 0, len(s))[1] == force(s)
    for t in (text, "", " lead", "a  b", "x\n y \n\nz", "tail "):
        assert p.decode(np.frombuffer(p.encode(t), "<u4")) == t
    for chunk in (17, 23, 40):
        parts = [(s[max(0, c - p.longest + 1) : c], s[c : c + chunk]) for c in range(0, len(s), chunk)]
        m = np.array([p.transfer(b, q) for b, q in parts])
        assert sentencepieces.scanned(m)[-1][0, 0] == force(s)


def test_sentencepieces_in_chunks(spark, odd, empty):
    giant = table(spark, [(1, words(9, 200), "s"), (2, "abc" * 400, "s"), (3, "the end\n" * 90, "s"), (4, "short", "s"), (4, "short", "s"), (None, words(10, 100), "s")])
    whole = sorted((str(r.doc_id), bytes(r.ids)) for r in sentencepieces.encode(giant, chunk=1 << 20).collect())
    parts = sorted((str(r.doc_id), bytes(r.ids)) for r in sentencepieces.encode(giant, chunk=50).collect())
    p = sentencepieces.Pieces()
    score = lambda ids: sum(p.known[p.text_of[i]][1] for i in np.frombuffer(ids, "<u4").tolist() if i in p.text_of)
    assert [(i, score(x)) for i, x in whole] == [(i, score(x)) for i, x in parts]
    back = {r.text for r in sentencepieces.decode(sentencepieces.encode(odd)).collect()}
    assert back == {r.text or "" for r in odd.collect()}
    assert sentencepieces.encode(empty).count() == 0


def test_classifiers(spark, odd, empty):
    rng = np.random.default_rng(4)
    toxic = [int(i % 4 == 0) for i in range(240)]
    texts = [words(700 + i, 40) + (" you idiot" if t else "") + " " + words(900 + i, int(rng.integers(1, 30))) for i, t in enumerate(toxic)]
    docs = table(spark, [(i, t, "s") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1 - t, t) for i, t in enumerate(toxic[:160])] + [(999, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert np.mean([(got[i] >= 0.3) == bool(t) for i, t in enumerate(toxic)][160:]) > 0.9
    assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, model).collect()) and toxicity.scored(odd, model).count() == odd.count()
    assert toxicity.scored(empty, toxicity.train(empty, labels.limit(0))).count() == 0
    junk = [t if good else " ".join(w + "$$$" for w in t.upper().split()) for t, good in zip(texts, [1 - t for t in toxic], strict=True)]
    shaped = table(spark, [(i, t, "s") for i, t in enumerate(junk)])
    learned = quality.train(shaped, labels)
    scores = {r.doc_id: r.score for r in quality.scored(shaped, learned).collect()}
    assert np.mean([(scores[i] >= 0.3) == (not t) for i, t in enumerate(toxic)][160:]) > 0.95
    kept = quality.scored(odd, learned, score_col="__s")
    assert kept.count() == odd.count() and kept.columns[:-1] == odd.columns
    assert quality.scored(empty, quality.train(empty, labels.limit(0))).count() == 0


def test_fixity(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "b" * (i % 50)) for i in range(300)] + [(None, None, None), (5, "http://h/5", "bbbbb")], "page_id long, url string, html string")
    kept = fixity.records(pages, file_bytes=9000).cache()
    assert kept.count() == 302
    for rows in (sorted(g) for g in [[(r.place, r.offset, r.length) for r in kept.collect() if r.file == f] for f in range(3)]):
        at = 0
        for n, (place, offset, length) in enumerate(rows):
            assert (place, offset) == (n, at)
            at += length
    assert fixity.audit(kept, kept).count() == 0
    second = kept.filter("NOT (page_id <=> 17)").withColumn("digest", F.when(F.col("page_id").isin(3, 250), F.lit("bad")).otherwise(F.col("digest")))
    found = kept.join(fixity.audit(kept, second), ["file", "place"])
    assert {(r.page_id, r.status) for r in found.collect()} == {(3, "corrupt"), (250, "corrupt"), (17, "missing")}
    assert fixity.replica_root(kept).first() == fixity.replica_root(kept).first() != fixity.replica_root(second).first()
    none = kept.limit(0)
    assert fixity.audit(none, none).count() == 0 and fixity.records(pages.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_bands_are_not_broadcast(spark, monkeypatch):
    """Nodes below Spark's broadcast limit have 32 times as many bands, which Spark does not see."""
    plans, saved = {}, common.saved

    def seen(df, name, **more):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return saved(df, name, **more)

    monkeypatch.setattr(common, "saved", seen)
    near_dedup.near_duplicates(table(spark, [(k, f"a{k % 7} b c d e f g h", "s") for k in range(30)])).count()
    assert "SortMergeJoin" in plans["near-buckets"] and "Broadcast" not in plans["near-buckets"]


def test_the_pipelines_near_copies_broadcast_no_bands(spark, monkeypatch):
    plans, saved = {}, common.saved

    def seen(df, name, **more):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return saved(df, name, **more)

    monkeypatch.setattr(common, "saved", seen)
    docs = table(spark, [(k, f"a{k % 7} b c d e f g h", "s") for k in range(30)])
    assert dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "").count() == 7
    assert "Broadcast" not in plans["near-buckets"]
