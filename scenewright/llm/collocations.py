"""Phrase collocations by broadcast double-array tries of Apriori-safe candidates (operator 11).

A text is split into pieces and words; a word stands for itself and its language as a 64-bit
symbol, so texts become arrays of symbols in numpy and phrases never cross a piece.

Level by level: words are counted in tasks and summed up by buckets. A pair is a candidate only if both
its words reach the least count, a triple only if both its pairs do. Tasks know the frequent
words (then pairs) as a bit filter of bounded size that has no false negatives, so no candidate
is lost and a false positive only costs a row. Of the pairs (triples) that pass, each task
sends the ones it holds with their number cut off at the least count: the sum of these
reaches the least count exactly where the true count does.

The candidates are dealt by hash to tries of about `SHARD` phrases, which tasks build as double
arrays. They are broadcast in packs of at most `PACK` phrases; one pass over the texts takes up
the packs in turn, goes on with the positions where a trie's bit filter lets a phrase start,
advances their states all at once, a level a step, and counts accepting states by bincount. The
tasks' sums are added up. Scores are taken in decimals.

Two words with one symbol would be counted as one: this is seen in the table of words, and the
symbols are then drawn anew.

Defined results: a null language is `und`; a null or empty text holds no words; repeated rows
count each time; an empty table gives no rows; of the input's columns only the language and the
text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .shingles import mixed

U64 = np.uint64
LEAST, SHARE, TOP = 10, 50, 2000
#: Phrases of one trie on average, and of the tries that are broadcast together.
SHARD, PACK = 1 << 16, 1 << 20
#: Bits of a filter for each member, and of the largest filter (128 MB).
BITS_EACH, BITS_MOST = 16, 1 << 30
#: Words whose phrases are counted together in a task; bytes of one language laid together; bytes hashed at once.
HELD, JOINED, BLOCK = 1 << 20, 1 << 20, 1 << 20
#: 0: part of a word, 1: blank, 2: ends a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWERED = np.frombuffer(bytes(range(256)).translate(bytes.maketrans(common.UPPER.encode(), common.LOWER.encode())), np.uint8)
ODD = U64(0x9E3779B97F4A7C15)
SEEDS = 4
#: Places in a word whose letters' numbers are looked up, not computed.
PLACES = 64
#: Buckets by which tasks deal out what they counted, and rows that are summed up together where they meet.
BUCKETS, MERGED = 1 << 10, 1 << 22
#: Bits of a trie's filter for each of its phrases.
TRIE_BITS = 16


# --- texts to symbols


def byte_table(seed: int) -> np.ndarray:
    """A random number for each byte; A-Z share those of a-z."""
    table = np.random.Generator(np.random.PCG64(7_000_001 + seed)).integers(0, 1 << 64, 256, dtype=U64)
    table[65:91] = table[97:123]
    return table


@lru_cache(4)
def placed_tables(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """What a letter adds to a word's symbol and to its second hash at each of the first PLACES places: place * 256 + letter."""
    place = np.repeat(np.arange(PLACES, dtype=U64) * ODD, 256)
    return mixed(np.tile(byte_table(seed), PLACES) + place), (np.tile(byte_table(seed + 1000), PLACES) ^ place) * ODD ^ place


def blocks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about BLOCK bytes that cut no word."""
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data):
            gap = np.flatnonzero(KIND[data[end : end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + BLOCK)
        yield at, end
        at = end


class Symbols:
    """Words of one language as they follow each other: symbols, the piece of each and, if strings are asked for, a second hash and where their bytes are."""

    def __init__(self, lang: str, seed: int, strings: bool):
        self.table, self.other = byte_table(seed), byte_table(seed + 1000)
        self.placed = placed_tables(seed)
        self.salt = mixed(np.array([int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")], U64) + U64(seed))
        self.lang, self.strings, self.size, self.pieces, self.parts = lang, strings, 0, 0, []

    def add(self, raw: bytes) -> None:
        data = np.frombuffer(raw, np.uint8)
        for at, end in blocks(data):
            part = data[at:end]
            kind = KIND[part]
            inside = kind == 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
            start, length = edge[::2], edge[1::2] - edge[::2]
            ended = np.cumsum(kind == 2, dtype=np.int32)
            if len(start):
                first = np.cumsum(length) - length
                letters = part[inside]
                place = np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), length)
                near = (np.minimum(place, PLACES - 1) << 8) + letters
                value = self.placed[0][near]
                other = self.placed[1][near] if self.strings else None
                if int(length.max()) > PLACES:
                    far = np.flatnonzero(place >= PLACES)
                    later = place[far].astype(U64) * ODD
                    value[far] = mixed(self.table[letters[far]] + later)
                    if self.strings:
                        other[far] = (self.other[letters[far]] ^ later) * ODD ^ later
                symbol = mixed(np.add.reduceat(value, first) ^ self.salt)
                check = np.add.reduceat(other, first) if self.strings else None
                self.parts.append((np.maximum(symbol, U64(1)), check, ended[start] + np.int32(self.pieces), start + at, length, raw) if self.strings else (np.maximum(symbol, U64(1)), None, ended[start] + np.int32(self.pieces)))
                self.size += len(start)
            self.pieces += int(ended[-1])
        self.pieces += 1

    def array(self, k: int, kind: type = U64) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *(p[k] for p in self.parts)])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.array(0), self.array(2, np.int32)

    def words(self, index: np.ndarray) -> pa.Array:
        """The words at the given positions, A-Z as a-z."""
        ends = np.cumsum([len(p[0]) for p in self.parts])
        of = np.searchsorted(ends, index, "right")
        size, letters = np.zeros(len(index), np.int64), [np.zeros(0, np.uint8)]
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(len(self.parts) + 1))
        for k, (*_, start, length, raw) in enumerate(self.parts):
            mine = order[bounds[k] : bounds[k + 1]]
            if len(mine):
                i = index[mine] - (int(ends[k]) - len(start))
                n = length[i]
                size[mine] = n
                at = np.repeat(start[i] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                letters.append(LOWERED[np.frombuffer(raw, np.uint8)[at]])
        offsets = np.concatenate([[0], np.cumsum(size[order])]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(index), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(letters))])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return found.take(pa.array(back))


def held_symbols(batches: Iterator[pa.RecordBatch], seed: int, strings: bool = False) -> Iterator[Symbols]:
    """The words of a task's texts (columns: language, text), language by language, about HELD at a time."""
    kept: dict[str, Symbols] = {}
    waiting: dict[str, list[bytes]] = {}

    def join(lang: str) -> None:
        kept.setdefault(lang, Symbols(lang, seed, strings)).add(b"\n".join(waiting.pop(lang)))

    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            waiting.setdefault(lang, []).append(text.as_py() or b"")
            size[lang] = size.get(lang, 0) + len(waiting[lang][-1])
            if size[lang] >= JOINED:
                join(lang)
                size[lang] = 0
                if sum(s.size for s in kept.values()) >= HELD:
                    yield from kept.values()
                    kept = {}
    for lang in list(waiting):
        join(lang)
    yield from kept.values()


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def turned_column(name: str, by: int) -> str:
    return f"(shiftleft({name}, {by}) | shiftrightunsigned({name}, {64 - by}))"


#: A phrase's hash, the same in numpy and in SQL.
PAIR, TRIPLE = f"g1 ^ {turned_column('g2', 23)}", f"g1 ^ {turned_column('g2', 23)} ^ {turned_column('g3', 41)}"


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ turned(b, 23)


def triple_hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return pair_hash(a, b) ^ turned(c, 41)


# --- candidates


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of distinct rows and how many there are of each. Rows that differ but share a hash are each given with 1."""
    key = columns[0]
    for k, c in enumerate(columns[1:]):
        key = mixed(key + U64(k + 1)) ^ c
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    index, count = order[starts], np.diff(starts, append=len(key))
    odd = np.zeros(len(key), bool)
    for c in columns if len(columns) > 1 else ():
        c = c[order]
        odd |= c != np.repeat(c[starts], count)
    if odd.any():
        count = count - np.add.reduceat(odd, starts, dtype=np.int64)
        index, count = np.concatenate([index, order[odd]]), np.concatenate([count, np.ones(int(odd.sum()), np.int64)])
    return index, count


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# What tasks count goes through the shuffle in parcels: a row for each bucket with its numbers side by side, and
# not a row for each number. Where parcels meet, numpy sorts and sums them.


def parcels(hashes: np.ndarray, columns: list[np.ndarray], words: pa.Array | None = None, **same: str) -> pa.RecordBatch:
    """(bucket, c0, c1, ..., perhaps words and columns with one value): the rows of arrays, dealt to buckets by their hashes."""
    bucket = (hashes % U64(BUCKETS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
    made = {"bucket": pa.array(np.arange(BUCKETS, dtype=np.int32))}

    def laid(data: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), BUCKETS, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])

    for k, c in enumerate(columns):
        c = np.ascontiguousarray(c[order])
        made[f"c{k}"] = laid(c, bounds * c.itemsize)
    if words is not None:
        at, data = binary_parts(words.take(pa.array(order)))
        made["words"] = laid(data, at[bounds])
    made |= {name: pa.repeat(value, BUCKETS) for name, value in same.items()}
    return pa.RecordBatch.from_pydict(made).filter(pa.array(np.diff(bounds) > 0))


def binary_parts(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 on, and the bytes that they cut."""
    _, offsets, data = found.buffers()
    at = np.frombuffer(offsets, np.int32)[found.offset : found.offset + len(found) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (at - at[0]).astype(np.int64), whole[at[0] : at[-1]]


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of a batch's parcels, end to end."""
    return np.frombuffer(binary_parts(column)[1].tobytes(), kind)


def dealt(found: DataFrame, by: str = "bucket") -> DataFrame:
    return found.repartition(max(12, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))), by)


WORD_PARCELS = "bucket int, c0 binary, c1 binary, c2 binary, c3 binary, words binary, lang string"


def count_words(seed: int):
    """Parcels of each stretch of texts: symbols, second hashes, how often, bytes of the words, and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in held_symbols(batches, seed, strings=True):
            symbol = held.array(0)
            if len(symbol):
                index, count = distinct([symbol, held.array(1)])
                words = held.words(index)
                symbol = symbol[index]
                yield parcels(mixed(symbol), [symbol, held.array(1)[index], count.astype(np.int64), np.diff(binary_parts(words)[0]).astype(np.int32)], words, lang=held.lang)

    return run


def merged_words(least: int):
    """(g, lang, word, n, clash) of the words that reach the least count; g null: of all words of a language that met here. clash: two words have one symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        held: list[tuple] = []
        clash = False

        def summed_up() -> None:
            nonlocal clash
            g, check, n, lang = (np.concatenate([h[k] for h in held]) for k in range(4))
            order = np.argsort(g)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(g[order]) != 0]))
            size = np.diff(starts, append=len(order))
            first = order[starts]
            clash |= bool((check[order] != np.repeat(check[first], size)).any() or (lang[order] != np.repeat(lang[first], size)).any())
            words = pa.concat_arrays([h[4] for h in held]).take(pa.array(first))
            held[:] = [(g[first], check[first], np.add.reduceat(n[order], starts), lang[first], words)]

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                g, check, n = unpacked(row.column(1), U64), unpacked(row.column(2), U64), unpacked(row.column(3), np.int64)
                at = np.concatenate([[0], np.cumsum(unpacked(row.column(4), np.int32))]).astype(np.int64)
                words = pa.Array.from_buffers(pa.large_binary(), len(g), [None, pa.py_buffer(at), pa.py_buffer(binary_parts(row.column(5))[1])])
                held.append((g, check, n, np.full(len(g), langs.setdefault(row.column(6)[0].as_py(), len(langs)), np.int32), words))
            if sum(len(h[0]) for h in held) > 2 * max(MERGED, len(held[0][0])):
                summed_up()
        if not held:
            return
        summed_up()
        g, _, n, lang, words = held[0]
        names, none = pa.array(list(langs)), pa.nulls(len(langs))
        sizes = [none.cast(pa.int64()), names, none.cast(pa.string()), pa.array(np.bincount(lang, n, len(langs)).astype(np.int64)), pa.repeat(clash, len(langs))]
        some = np.flatnonzero(n >= least)
        rows = [signed(g[some]), names.take(pa.array(lang[some])), words.take(pa.array(some)).cast(pa.large_string()).cast(pa.string()), pa.array(n[some]), pa.repeat(clash, len(some))]
        for columns in (sizes, rows):
            yield pa.RecordBatch.from_arrays(columns, ["g", "lang", "word", "n", "clash"])

    return run


def merged_phrases(words: int, least: int):
    """(g1, g2, g3) of the phrases of so many words whose numbers sum up to the least count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def summed_up() -> None:
            *columns, n = (np.concatenate([h[k] for h in held]) for k in range(words + 1))
            order = np.argsort(triple_hash(*columns) if words == 3 else pair_hash(*columns))
            starts = differs(columns, order)
            if len(starts) > 1:
                key = mixed(triple_hash(*columns) if words == 3 else pair_hash(*columns))[order[starts]]
                if len(np.unique(key)) < len(key):  # phrases that share a hash may lie among each other
                    order = np.lexsort(columns)
                    starts = differs(columns, order)
            held[:] = [(*(c[order[starts]] for c in columns), np.add.reduceat(n[order], starts))]

        for batch in batches:
            held.append((*(unpacked(batch.column(k + 1), U64) for k in range(words)), unpacked(batch.column(words + 1), np.int32).astype(np.int64)))
            if sum(len(h[0]) for h in held) > 2 * max(MERGED, len(held[0][0])):
                summed_up()
        if not held:
            return
        summed_up()
        *columns, n = held[0]
        some = np.flatnonzero(n >= least)
        arrays = [signed(c[some]) for c in columns] + [pa.nulls(len(some), pa.int64())] * (3 - words)
        yield pa.RecordBatch.from_arrays(arrays, ["g1", "g2", "g3"])

    return run


def differs(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Where rows, taken in order, begin that are unlike the one before."""
    new = np.concatenate([[True], np.zeros(len(order) - 1, bool)])
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def within(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the hashes; it has a power of two of bits."""
    found = np.ones(len(hashes), bool)
    for shift in (0, 32):
        at = (hashes >> U64(shift)) & U64(8 * len(bits) - 1)
        found &= (bits[at >> U64(3)] >> (at & U64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def filter_bits(members: DataFrame, key: str, n: int) -> np.ndarray:
    """A bit filter over 64-bit hashes, made by tasks in slices of 4 KB: two bits a member, at most BITS_MOST in all."""
    size = min(BITS_MOST, max(1 << 15, 1 << (BITS_EACH * max(n, 1) - 1).bit_length()))
    places = members.select(F.explode(F.expr(f"array({key} & {size - 1}L, shiftrightunsigned({key}, 32) & {size - 1}L)")).alias("p")).select((F.col("p") + 1).alias("p"))
    slices = places.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for k, bits in slices.toLocalIterator():
        out[(k - 1) << 12 : k << 12] = np.frombuffer(bits, np.uint8)
    return out


def filtered_phrases(seed: int, bits, words: int, least: int):
    """Parcels (symbols, number cut off at least) of the pairs whose words, or the triples whose pairs, may be in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in held_symbols(batches, seed):
            symbol, piece = held.arrays()
            if len(symbol) < words:
                continue
            known = within(bits.value, symbol if words == 2 else pair_hash(symbol[:-1], symbol[1:]))
            at = np.flatnonzero(known[:-1] & known[1:] & (piece[: len(known) - 1] == piece[words - 1 :]))
            columns = [symbol[at + k] for k in range(words)]
            index, count = distinct(columns)
            columns = [c[index] for c in columns]
            yield parcels(mixed(triple_hash(*columns) if words == 3 else pair_hash(*columns)), [*columns, np.minimum(count, least).astype(np.int32)])

    return run


# --- tries


def build_trie(phrases: np.ndarray) -> dict[str, np.ndarray]:
    """A double array over rows of three symbols (the last 0 for a pair): from state s by code c to base[s] + c, if check says s.

    `symbols` gives the codes (index + 1), `accepts` the row of a state, -1 for none.
    """
    symbols = np.unique(phrases[phrases > 0])
    codes = np.where(phrases > 0, np.searchsorted(symbols, phrases) + 1, 0).astype(np.int64)
    wide = len(symbols) + 1
    first, in_first = np.unique(codes[:, 0], return_inverse=True)
    second, in_second = np.unique(in_first * wide + codes[:, 1], return_inverse=True)
    longer = codes[:, 2] > 0
    third, in_third = np.unique(in_second[longer] * wide + codes[longer, 2], return_inverse=True)
    parent = np.concatenate([second // wide, len(first) + third // wide])
    code = np.concatenate([second % wide, third % wide])
    starts = np.flatnonzero(np.diff(parent, prepend=-1))
    size = np.diff(starts, append=len(parent))
    owner = parent[starts]
    # root is state 0 and its children's states are their codes; the children of all other states are fitted in after them
    used = np.zeros(2 * wide + len(parent) + len(parent) // 2, bool)
    used[:wide] = True
    base = np.zeros(len(first) + len(second), np.int64)
    rng = np.random.Generator(np.random.PCG64(5))
    for k in np.argsort(-size, kind="stable")[: int((size > 1).sum())]:
        own = code[starts[k] : starts[k] + size[k]]
        room = len(used) - own[-1]
        for _ in range(8):
            tried = rng.integers(wide - own[0], room, 32)
            free = ~used[tried[:, None] + own].any(1)
            if free.any():
                base[owner[k]] = tried[int(np.argmax(free))]
                break
        else:
            base[owner[k]] = len(used) - own[0]
            used = np.concatenate([used, np.zeros(own[-1] - own[0] + 1, bool)])
        used[base[owner[k]] + own] = True
    alone = np.flatnonzero(size == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(alone):
        free = np.concatenate([free, len(used) + np.arange(len(alone) - len(free))])
    base[owner[alone]] = free[: len(alone)] - code[starts[alone]]
    state_1 = first
    state_2 = base[second // wide] + second % wide
    state_3 = base[len(first) + third // wide] + third % wide
    slots = max(int(s.max(initial=0)) for s in (state_1, state_2, state_3)) + 1
    out = {"symbols": symbols, "base": np.zeros(slots, np.int32), "check": np.full(slots, -1, np.int32), "accepts": np.full(slots, -1, np.int32)}
    out["check"][state_1] = 0
    out["check"][state_2] = state_1[second // wide]
    out["check"][state_3] = state_2[third // wide]
    out["base"][state_1], out["base"][state_2] = base[: len(first)], base[len(first) :]
    out["accepts"][state_2[in_second[~longer]]] = np.flatnonzero(~longer)
    out["accepts"][state_3[in_third]] = np.flatnonzero(longer)
    return out


def step(trie: dict[str, np.ndarray], states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The states after one more symbol each, -1 for none."""
    code = np.searchsorted(trie["symbols"], symbols)
    known = code < len(trie["symbols"])
    known[known] = trie["symbols"][code[known]] == symbols[known]
    to = trie["base"][states] + code + 1
    known &= (to >= 0) & (to < len(trie["check"]))
    known[known] = trie["check"][to[known]] == states[known]
    return np.where(known, to, -1)


def accepted(trie: dict[str, np.ndarray], symbols: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """Rows of the phrases of so many words that start at the positions, one for each hit."""
    states = np.zeros(len(at), np.int64)
    for k in range(words):
        states = step(trie, states, symbols[at + k])
        alive = states >= 0
        at, states = at[alive], states[alive]
    rows = trie["accepts"][states]
    return rows[rows >= 0]


#: What of a trie is sent to the tasks, and the kinds of its numbers.
SENT = {"symbols": U64, "base": np.int32, "check": np.int32, "accepts": np.int32, "bits": np.uint8}
TRIE = "shard int, n long, symbols binary, base binary, check binary, accepts binary, bits binary, phrases binary"


def trie_bits(phrases: np.ndarray) -> np.ndarray:
    """A bit filter of a trie's phrases, so that only positions where one may start are walked."""
    g1, g2, g3 = phrases.T
    hashes = mixed(np.where(g3 == 0, pair_hash(g1, g2), triple_hash(g1, g2, g3)))
    size = max(1 << 9, 1 << (TRIE_BITS * len(phrases) - 1).bit_length())
    out = np.zeros(size, bool)
    for shift in (0, 32):
        out[(hashes >> U64(shift)) & U64(size - 1)] = True
    return np.packbits(out, bitorder="little")


def build_shard(frame: pd.DataFrame) -> pd.DataFrame:
    phrases = frame[["g1", "g2", "g3"]].to_numpy(np.int64).view(U64)
    made = build_trie(phrases) | {"bits": trie_bits(phrases), "phrases": phrases}
    return pd.DataFrame([{"shard": frame["shard"].iloc[0], "n": len(frame), **{k: made[k].tobytes() for k in (*SENT, "phrases")}}])


def tries(candidates: DataFrame, shards: int) -> DataFrame:
    """(g1, g2, g3 or null) dealt to so many tries by their hashes, each built in a task."""
    place = F.when(F.col("g3").isNull(), F.expr(f"pmod({PAIR}, {shards}L)")).otherwise(F.expr(f"pmod({TRIPLE}, {shards}L)"))
    dealt = candidates.select("g1", "g2", F.coalesce("g3", F.lit(0)).alias("g3"), place.cast("int").alias("shard"))
    return dealt.groupBy("shard").applyInPandas(build_shard, TRIE)


class Placed:
    """Positions of words that follow each other where a phrase of so many may start, with its hash, ordered by its trie."""

    def __init__(self, symbol: np.ndarray, piece: np.ndarray, words: int, shards: int):
        at = np.flatnonzero(piece[: 1 - words] == piece[words - 1 :]).astype(np.int32)
        own = [symbol[at + k] for k in range(words)]
        hashes = pair_hash(*own) if words == 2 else triple_hash(*own)
        del own
        # numbers of two bytes are sorted digit by digit
        place = (hashes.view(np.int64) % shards).astype(np.int16 if shards < 1 << 15 else np.int32)
        order = np.argsort(place, kind="stable")
        self.bounds = np.searchsorted(place[order], np.arange(shards + 1))
        self.at, self.hashes, self.symbol, self.words = at[order], mixed(hashes[order]), symbol, words

    def hits(self, shard: int, trie: dict[str, np.ndarray]) -> np.ndarray:
        mine = slice(self.bounds[shard], self.bounds[shard + 1])
        return accepted(trie, self.symbol, self.at[mine][within(trie["bits"], self.hashes[mine])], self.words)


def count_phrases(seed: int, packs: list, shards: int):
    """(shard, rows, counts): how often the phrases of packs of tries occur in a task's texts, the numbers of a trie side by side.

    A task goes through its texts once for all packs and holds one of them at a time: of several,
    each is read again from the executor's disk for every stretch of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for symbol, piece in joined(held_symbols(batches, seed), HELD * min(2, len(packs))):
            placed = [Placed(symbol, piece, words, shards) for words in (2, 3)]
            for pack in packs:
                found = pack.value
                for k, trie in found.items():
                    hits = np.concatenate([p.hits(k, trie) for p in placed])
                    counts[k] = counts.get(k, 0) + np.bincount(hits, minlength=trie["n"])
                del found, trie
                if len(packs) > 1:
                    vars(pack).pop("_value", None)  # what a worker keeps of a broadcast that it has read
        for k, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([some.astype(np.int32).tobytes()]), pa.array([n[some].tobytes()])], ["shard", "rows", "counts"])

    return run


def summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, rows, counts) of all tasks -> (shard, row, n)."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, rows, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            rows, counts = np.frombuffer(rows.as_buffer(), np.int32), np.frombuffer(counts.as_buffer(), np.int64)
            if not len(rows):
                continue
            held = sums.setdefault(shard, np.zeros(0, np.int64))
            if len(held) <= rows[-1]:
                held = sums[shard] = np.concatenate([held, np.zeros(rows[-1] + 1 - len(held), np.int64)])
            held[rows] += counts
    for shard, n in sums.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.repeat(np.int32(shard), len(some)), pa.array(some.astype(np.int32)), pa.array(n[some])], ["shard", "row", "n"])


def joined(stretches: Iterator[Symbols], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and pieces of stretches (of any language), laid together up to about so many words."""
    held, words, pieces = [], 0, 0
    for stretch in stretches:
        symbol, piece = stretch.arrays()
        held.append((symbol, piece + np.int32(pieces)))
        words, pieces = words + len(symbol), pieces + stretch.pieces + 1
        if words >= size:
            yield np.concatenate([s for s, _ in held]), np.concatenate([p for _, p in held])
            held, words, pieces = [], 0, 0
    if words:
        yield np.concatenate([s for s, _ in held]), np.concatenate([p for _, p in held])


def phrases_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, phrases) -> (shard, row, g1, g2, g3)."""
    for batch in batches:
        for shard, phrases in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            g = np.frombuffer(phrases.as_buffer(), np.int64).reshape(-1, 3)
            columns = [np.ascontiguousarray(c) for c in g.T]
            yield pa.RecordBatch.from_arrays([pa.repeat(np.int32(shard), len(g)), pa.array(np.arange(len(g), dtype=np.int32)), pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], mask=columns[2] == 0)], ["shard", "row", "g1", "g2", "g3"])


def counted_by_tries(texts: DataFrame, candidates: DataFrame, seed: int) -> DataFrame:
    """(g1, g2, g3, n) of all candidates that occur, in one pass over the texts. At most PACK phrases, about 100 bytes each, are on the driver at a time."""
    shards = -(-candidates.count() // SHARD)
    if not shards:
        return candidates.select("g1", "g2", "g3", F.lit(0).cast("long").alias("n"))
    built = common.saved(tries(candidates, shards), "phrase-tries")
    per_pack, packs = max(1, PACK // SHARD), []
    for low in range(0, shards, per_pack):
        pack = {}
        # Arrow: what comes to the driver is passed on as it is, without a copy for each row
        rows = built.filter(F.col("shard").between(low, low + per_pack - 1)).select("shard", "n", *SENT).toArrow()
        for k in range(rows.num_rows):
            pack[rows["shard"][k].as_py()] = {"n": rows["n"][k].as_py()} | {name: np.frombuffer(rows[name][k].as_buffer(), kind) for name, kind in SENT.items()}
        del rows
        if pack:
            packs.append(texts.sparkSession.sparkContext.broadcast(pack))
            # the driver needs a pack's file alone from here on
            vars(packs[-1]).pop("_value", None)
        del pack
    found = texts.mapInArrow(count_phrases(seed, packs, shards), "shard int, rows binary, counts binary")
    out = common.saved(dealt(found, "shard").mapInArrow(summed_counts, "shard int, row int, n long"), "phrase-counts")
    for pack in packs:
        pack.destroy()
    named = built.select("shard", "phrases").mapInArrow(phrases_of, "shard int, row int, g1 long, g2 long, g3 long")
    return out.join(named, ["shard", "row"]).select("g1", "g2", "g3", "n")


# --- scores


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    return F.expr(f"(cast(1000000 AS decimal(7,0)) * (cast({a} AS decimal(15,0)) * cast({a} AS decimal(15,0)))) div (cast({left} AS decimal(15,0)) * cast({right} AS decimal(15,0)))")


def count_table(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (g, lang, word, n), sizes (lang, n), and the counts (g1, g2, g3, n) of all phrases of two and three words that reach the least count."""
    spark = texts.sparkSession
    for seed in range(SEEDS):
        found = texts.mapInArrow(count_words(seed), WORD_PARCELS)
        words = dealt(found).mapInArrow(merged_words(least), "g long, lang string, word string, n long, clash boolean")
        words = common.saved(words, "phrase-words")
        if words.filter("clash").isEmpty():
            break
    else:
        raise ValueError(f"words share a symbol under {SEEDS} seeds")
    sizes = words.filter("g IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.filter("g IS NOT NULL").select("g", "lang", "word", "n")
    levels, members, key = [], words, "g"
    for size in (2, 3):
        bits = spark.sparkContext.broadcast(filter_bits(members, key, members.count()))
        rows = texts.mapInArrow(filtered_phrases(seed, bits, size, least), "bucket int, " + ", ".join(f"c{k} binary" for k in range(size + 1)))
        rows = dealt(rows).mapInArrow(merged_phrases(size, least), "g1 long, g2 long, g3 long")
        levels.append(common.saved(rows, "phrase-candidates"))
        bits.destroy()
        members, key = levels[-1].select(F.expr(PAIR).alias("g")), "g"
    counts = counted_by_tries(texts, levels[0].unionByName(levels[1]), seed)
    return words, sizes, counts.filter(F.col("n") >= least)


def collocations(docs: DataFrame, *, least: int = LEAST, share: int = SHARE, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two and three words."""
    common.bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words, sizes, counts = count_table(texts, least)
    pairs = counts.filter("g3 IS NULL").select("g1", "g2", F.col("n").alias("a"))
    triples = counts.filter("g3 IS NOT NULL").withColumnRenamed("n", "a")

    def word(k: int) -> DataFrame:
        return words.select(F.col("g").alias(f"g{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))

    inside = triples.select("a", F.explode(F.array(F.struct("g1", "g2"), F.struct(F.col("g2").alias("g1"), F.col("g3").alias("g2")))).alias("p"))
    inside = inside.groupBy("p.g1", "p.g2").agg(F.max("a").alias("longer"))
    two = pairs.join(inside, ["g1", "g2"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    two = two.join(word(1), "g1").join(word(2), "g2").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.array(F.struct(score("a", "f1", "f2").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f2").alias("r"))).alias("cuts"))
    three = triples.join(pairs.select("g1", "g2", F.col("a").alias("f12")), ["g1", "g2"]).join(pairs.select(F.col("g1").alias("g2"), F.col("g2").alias("g3"), F.col("a").alias("f23")), ["g2", "g3"])
    three = three.join(word(1), "g1").join(word(2), "g2").join(word(3), "g3")
    cuts = [F.struct(score("a", left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")) for k, left, right in ((1, "f1", "f23"), (2, "f12", "f3"))]
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.array(*cuts).alias("cuts"))
    scored = two.unionByName(three).withColumn("c", F.array_min("cuts")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of parts first, so that no task ranks a whole language
    part = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.documents(spark, sf_dir))


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
f AS (
  SELECT lang, p, len(p) AS k, count(*) AS a FROM (
    SELECT lang, unnest([[w[i]], w[i:i+1], w[i:i+2]]) AS p, unnest([1, 2, 3]) AS k, len(w) - i + 1 AS room FROM placed) WHERE k <= room GROUP BY lang, p),
sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND a >= {LEAST}),
inner_ AS (SELECT lang, p, max(a) AS longer FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS p FROM c WHERE k = 3) GROUP BY lang, p),
cuts AS (
  SELECT c.lang, c.p, c.a, cut, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.cut] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
kept AS (SELECT l.*, array_to_string(l.p, ' ') AS phrase FROM lowest l LEFT JOIN inner_ i USING (lang, p) WHERE i.longer IS NULL OR 100 * i.longer < {SHARE} * l.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
