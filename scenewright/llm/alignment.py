"""Alignment of two tokenizers by inverted pair bitmaps (operator 12).

Each text is encoded twice. Where tokens of both end at the same byte, a group ends; where a
token of either ends, a link ends: a link is one token of A and one of B that share bytes.

Tasks invert their documents: for each pair of ids a document bitmap with multiplicity planes,
plane k holding the documents in which the pair's number of links has bit k set. The documents
of a task are numbered in blocks of at most `DOCS`; the bitmaps of a block's batches of texts
are OR-ed, and a bitmap is kept as sorted 16-bit numbers or as bits, whichever is smaller.
Popcounts give a pair's documents (all planes OR-ed) and its links (plane k counts 2**k). They
are summed over the blocks, compared with the highest of the pair's B id, and
sent back to the blocks that hold the pair; there the postings add them to their documents.
Only counts are shuffled by pair, so a pair that every document holds is a row per block.

Ids of A are looked up in the ranks of its own file by tiktoken, which gives the same ids
faster; texts with very long runs of letters, where that takes quadratic time, and
files that are no plain byte-level vocabularies go through the tokenizers library.

Defined results: null and empty texts, and texts that a tokenizer does not give back byte for
byte, have no tokens: zeros and an empty digest; repeated rows count each time, null ids pass
through; an empty table gives no rows; of the input's columns only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .memo import worker_memory

#: Documents of a block at most, its postings (pair and document) before it is closed, and bytes of text encoded together.
DOCS, HELD, BYTES = 65_535, 1 << 22, 1 << 20
#: Runs that go through the tokenizers library.
LONG_RUN = re.compile(rb"[^ \n]{2000}|[ \n\t\r]{500}")
B_BITS = 24
DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCK = f"block long, docs array<struct<{DOC.replace(' ', ':').replace(',:', ',')}>>, pairs array<long>, documents array<long>, links array<long>, planes binary, members binary, sparse binary, dense binary"
RESULT = f"{DOC}, n_best long, count_sum long"


# --- the two tokenizers


def byte_level() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def first_tokenizer(path: str | None) -> tuple[Callable[[list[str]], list], list[bytes]]:
    """(encode a list of texts, bytes of each id) of a byte-level vocabulary file of the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    characters, special = byte_level(), {i for i, t in model.get_added_tokens_decoder().items() if t.special}
    pieces = [b""] * model.get_vocab_size()
    for token, i in model.get_vocab().items():
        if i not in special:
            pieces[i] = bytes(characters[c] for c in token)
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    before, merging = said.get("pre_tokenizer") or {}, said["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not said.get("normalizer")
    plain = plain and not merging.get("ignore_merges") and not merging.get("dropout") and set(range(len(pieces))) - special == set(range(len(pieces) - len(special)))

    def slow(texts: list[str]) -> list:
        return [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    if not plain:
        return slow, pieces
    ranks = {p: i for i, p in enumerate(pieces) if i not in special}
    fast = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list:
        return [slow([t])[0] if LONG_RUN.search(t.encode()) else fast.encode_ordinary(t) for t in texts]

    return encode, pieces


def second_tokenizer(path: str | None) -> tuple[Callable[[list[str]], list], list[bytes]]:
    """The same of a model file of the sentencepiece library."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return (lambda texts: model.encode(texts, num_threads=1)), pieces


class Pair:
    """Both tokenizers of a worker, the lengths of their tokens and the texts of their ids."""

    def __init__(self, path_a: str | None, path_b: str | None):
        kept = worker_memory(f"aligned {path_a} {path_b}")
        if not kept:
            (encode_a, a), (encode_b, b) = first_tokenizer(path_a), second_tokenizer(path_b)
            named = [f"{i}{s}" for i in range(len(a)) for s in ",|"] + [f"{i}{s}" for i in range(len(b)) for s in ",;"]
            kept |= {"a": (encode_a, a, np.array([len(p) for p in a])), "b": (encode_b, b, np.array([len(p) for p in b])), "named": np.array(named, "S"), "second": 2 * len(a)}
        self.a, self.b, self.named, self.second = kept["a"], kept["b"], kept["named"], kept["second"]

    def encode(self, texts: list[str]) -> tuple[list[bool], tuple[list, list]]:
        """Which texts come back whole from both, and the ids of these."""
        want = [b" " + t.encode() for t in texts]
        ids_a, ids_b = self.a[0]([f" {t}" for t in texts]), self.b[0](texts)
        whole = [bool(t) and all(b"".join([pieces[i] for i in ids]) == w for ids, (_, pieces, _) in ((x, self.a), (y, self.b))) for t, w, x, y in zip(texts, want, ids_a, ids_b, strict=True)]
        return whole, tuple([ids for ids, ok in zip(found, whole, strict=True) if ok] for found in (ids_a, ids_b))


def aligned(pair: Pair, ids_a: list, ids_b: list) -> dict[str, np.ndarray | list]:
    """Links and groups of texts laid end to end: ids a and b of the links, and for each text n_a, n_b, n_links, n_groups and the groups' digest."""
    out, ends, ids, mark = {}, {}, {}, {}
    for side, found, (_, _, length) in (("a", ids_a, pair.a), ("b", ids_b, pair.b)):
        out[f"n_{side}"] = np.array([len(x) for x in found], np.int64)
        ids[side] = np.fromiter(chain.from_iterable(found), np.int64, int(out[f"n_{side}"].sum()))
        ends[side] = np.cumsum(length[ids[side]])
    total = int(ends["a"][-1])
    for side in "ab":
        mark[side] = np.zeros(total + 1, bool)
        mark[side][ends[side]] = True
    both = mark["a"] & mark["b"]
    stops = ends["a"][np.cumsum(out["n_a"]) - 1]
    at = np.flatnonzero(mark["a"] | mark["b"])
    before = {side: np.cumsum(mark[side], dtype=np.int32) for side in "ab"}
    for side in "ab":
        out[side] = ids[side][before[side][at] - mark[side][at]]
    out["n_links"] = np.diff(np.searchsorted(at, stops, "right"), prepend=0)
    groups = np.cumsum(both, dtype=np.int32)
    out["n_groups"] = np.diff(groups[stops], prepend=0)
    # the groups as text: tokens of A, then of B, group by group
    last = np.flatnonzero(both)
    a_through, b_through = before["a"][last], before["b"][last]
    group = {side: groups[ends[side]] - both[ends[side]] for side in "ab"}
    code = np.empty(len(ids["a"]) + len(ids["b"]), np.int64)
    code[np.arange(len(ids["a"])) + np.concatenate([[0], b_through])[group["a"]]] = 2 * ids["a"] + both[ends["a"]]
    code[np.arange(len(ids["b"])) + a_through[group["b"]]] = pair.second + 2 * ids["b"] + both[ends["b"]]
    bounds = np.concatenate([[0], np.cumsum(out["n_a"] + out["n_b"])])
    out["digest"] = []
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        raw = pair.named[code[s:e]].view(np.uint8)
        out["digest"].append(hashlib.sha256(raw[raw > 0][:-1].tobytes()).hexdigest())
    return out


# --- the index


def packed(keys: np.ndarray, counts: np.ndarray, docs: int) -> dict[str, np.ndarray]:
    """Postings (pair << 16 | document, sorted; how many links) as planes: what `unpacked` reads back.

    planes: how many planes each pair has; members: documents of each plane; a plane is in
    `dense` as bits where that is smaller, else in `sparse` as numbers.
    """
    pairs, of = np.unique(keys >> np.uint64(16), return_inverse=True)
    doc = (keys & np.uint64(0xFFFF)).astype(np.uint16)
    height = int(counts.max(initial=1)).bit_length()
    slot, entry = [], []
    for k in range(height):
        on = np.flatnonzero(counts >> k & 1)
        slot.append(of[on] * height + k)
        entry.append(on)
    slot, entry = np.concatenate(slot), np.concatenate(entry)
    order = np.argsort(slot, kind="stable")
    slot, entry = slot[order], entry[order]
    members = np.bincount(slot, minlength=len(pairs) * height)
    wide = (docs + 7) // 8
    as_bits = 2 * members > wide
    held = as_bits[slot]
    rows = np.cumsum(as_bits) - 1
    dense = np.zeros((int(as_bits.sum()), wide), np.uint8)
    place = doc[entry[held]]
    np.bitwise_or.at(dense, (rows[slot[held]], place >> 3), (1 << (place & 7)).astype(np.uint8))
    weights = 1 << np.arange(height)
    links = (members.reshape(-1, height) * weights).sum(1)
    return {
        "pairs": pairs.astype(np.int64), "documents": np.bincount(of, minlength=len(pairs)), "links": links,
        "planes": np.array([height], np.uint8), "members": members.astype("<u2"), "sparse": doc[entry[~held]].astype("<u2"), "dense": dense,
    }


def unpacked(row: dict, docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the pair, plane, document) of all postings of a block, in stretches of bounded size."""
    height, members = row["planes"][0], np.frombuffer(row["members"], "<u2").astype(np.int64)
    wide = (docs + 7) // 8
    as_bits = 2 * members > wide
    some = np.flatnonzero(~as_bits & (members > 0))
    slot = np.repeat(some, members[some])
    yield slot // height, slot % height, np.frombuffer(row["sparse"], "<u2").astype(np.int64)
    dense, slots = np.frombuffer(row["dense"], np.uint8).reshape(-1, wide), np.flatnonzero(as_bits)
    step = max(1, (1 << 20) // wide)
    for k in range(0, len(slots), step):
        r, doc = np.nonzero(np.unpackbits(dense[k : k + step], axis=1, bitorder="little"))
        slot = slots[k + r]
        yield slot // height, slot % height, doc


def inverted(path_a: str | None, path_b: str | None):
    """Blocks of a task's documents (columns: id, text)."""

    def closed(number: int, docs: list[dict], keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        key, count = (np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.uint64, keys), (np.int64, counts)))
        order = np.argsort(key, kind="stable")
        made = packed(key[order], count[order], len(docs)) if len(key) else {}
        row: dict = {"block": (TaskContext.get().partitionId() << 32) + number, "docs": docs}
        for name, kind in (("pairs", "long"), ("documents", "long"), ("links", "long"), ("planes", ""), ("members", ""), ("sparse", ""), ("dense", "")):
            found = made.get(name, np.zeros(0, np.int64))
            row[name] = found if kind else found.tobytes()
        whole, numbers = pa.struct([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DOC.split(", ")]), pa.list_(pa.int64())
        kinds = {"block": pa.int64(), "docs": pa.list_(whole), "pairs": numbers, "documents": numbers, "links": numbers}
        return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds.get(n, pa.binary())) for n in row], list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        number, docs, keys, counts = 0, [], [], []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < BYTES and len(docs) + end - at < DOCS:
                    size += len(texts[end])
                    end += 1
                whole, found = pair.encode(texts[at:end])
                made = aligned(pair, *found) if any(whole) else None
                place, k = [], 0
                for i, ok in zip(ids[at:end], whole, strict=True):
                    row = {"doc_id": i, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
                    if ok:
                        row |= {n: int(made[n][k]) for n in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": made["digest"][k]}
                        place.append(len(docs))
                        k += 1
                    docs.append(row)
                if made:
                    key = (made["a"] << B_BITS | made["b"]) << 16 | np.repeat(place, made["n_links"])
                    key, count = np.unique(key.astype(np.uint64), return_counts=True)
                    keys.append(key), counts.append(count)
                at = end
                if len(docs) >= DOCS or sum(map(len, keys)) >= HELD:
                    yield closed(number, docs, keys, counts)
                    number, docs, keys, counts = number + 1, [], [], []
        if docs:
            yield closed(number, docs, keys, counts)

    return run


def index(docs: DataFrame, *, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: a row for each block of documents, saved in the shared folder."""
    common.bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.saved(rows.mapInArrow(inverted(path_a, path_b), BLOCK), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, a, b, documents, links, best (whether no pair of this b has more links)."""
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "documents", "links")).alias("p"))
    sums = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("documents"), F.sum("p.links").alias("links"))
    sums = sums.withColumns({"a": F.shiftright("pair", B_BITS), "b": F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))})
    sums = common.saved(sums, "aligned-pairs")
    most = sums.groupBy("b").agg(F.max("links").alias("most"))
    return sums.join(most, "b").select("pair", "a", "b", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def returned(scores: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of one block with what the scores of its pairs add up to."""
    row = blocks.to_pylist()[0]
    docs = row["docs"]
    n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    if row["pairs"]:
        order = np.argsort(scores["pair"].to_numpy())
        links, best = scores["links"].to_numpy()[order], scores["best"].to_numpy(zero_copy_only=False)[order]
        for pair, plane, doc in unpacked(row, len(docs)):
            times = np.int64(1) << plane
            np.add.at(count_sum, doc, times * links[pair])
            np.add.at(n_best, doc, times * best[pair])
    names = [c.split()[0] for c in DOC.split(", ")]
    columns = {n: pa.array([d[n] for d in docs], pa.string() if n == "groups_sha256" else pa.int64()) for n in names}
    return pa.table(columns | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)})


def alignment(docs: DataFrame, *, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum for every row of docs."""
    blocks = index(docs, path_a=path_a, path_b=path_b, id_col=id_col, text_col=text_col)
    asked = blocks.select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    scores = asked.join(pair_counts(blocks).select("pair", "links", "best"), "pair").select("of", "pair", "links", "best")
    held = blocks.select("block", "docs", "pairs", "planes", "members", "sparse", "dense")
    return scores.groupBy("of").cogroup(held.groupBy("block")).applyInArrow(returned, RESULT)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(common.documents(spark, sf_dir))
