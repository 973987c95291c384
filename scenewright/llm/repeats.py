"""Removal of long repeated byte strings by merging Burrows-Wheeler transforms (operator 2).

Equal texts are one text with several copies, which repeat each other whole. A string of
`length` bytes always holds one anchor: the `GRAM`-byte string of least hash in it. Equal
strings have equal anchors at equal offsets, so the strings that can repeat are those around
anchors that occur twice. The bytes around such an anchor are its context; contexts with the
same bytes (by a 128-bit cryptographic digest) are one context that occurs several times.

The distinct contexts of an anchor, aligned at it, are dealt to shards. Each shard gets its
Burrows-Wheeler transform: for every column, from the last to the first, the symbols before
its sorted suffixes. The transforms are then merged: the interleaving of the shards' suffixes
at one column follows from that at the next by a stable partition on the merged symbols, so
no suffix is compared or sorted again, and parts that all agree stay as they are. The common
prefix of neighbours follows from the range minimum of the prefixes between them, and every
interval of the order with a common prefix of `length` or more is a repeat. All symbols are
bytes of the texts, so what a hash put together by chance parts again here.

A group with more than `GROUP` contexts is divided first: of the bytes that a window holds
around its anchor, at least half lie on one side, so each context goes on as up to two, with
the windows that reach far enough to the left or right, grouped by the longer string that
they share. This is repeated until groups are small or the string is the whole window, and
groups of whole windows are counted. The result does not depend on `GROUP`.

Spans are in UTF-8 bytes and judged on the input. Defined results: null texts are empty;
texts shorter than `length` never match; repeated rows and rows with equal texts repeat each
other whole, null ids or not; the columns of the input, whatever their names, are passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .shingles import BASE, mixed

LENGTH = 400
GRAM = 128
#: Contexts that one task merges at once for one group.
GROUP = 1000
#: Contexts merged in one call, and shards that they are dealt to.
MERGED = 3000
SHARDS = 4
#: Window starts looked at together.
STRETCH = 1 << 18
U64 = np.uint64
LOW = U64((1 << 20) - 1)
_tables: list[np.ndarray] = []


def tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, BASE**i and BASE**-i modulo 2**64 for i <= n."""
    if not _tables or len(_tables[1]) <= n:
        made = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(max(n, 1 << 14) + 1, b, U64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _tables[:] = [mixed(np.arange(1, 257, dtype=U64)), *made]
    return _tables[0], _tables[1], _tables[2]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each width neighbours: running minima from both ends of blocks."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(U64).max, U64)
    full[: len(x)] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each stretch its start, and of each run of windows with one anchor: the anchor's hash, the first window, the number of windows, the bytes before the anchor."""
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, len(data) - length + 1, STRETCH):
        part = data[at : at + STRETCH + length - 1]
        byte, power, inverse = tables(len(part))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(byte[part] * power[: len(part)], out=total[1:])
        grams = mixed((total[gram:] - total[:-gram]) * inverse[: len(part) - gram + 1])
        place = np.arange(len(grams), dtype=U64)
        least = sliding_least((grams & ~LOW) | place, length - gram + 1) & LOW
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        anchor = least[start].astype(np.int64)
        yield at, grams[anchor].view(np.int64), start + at, np.diff(np.append(start, len(least))), anchor - start


def step(symbol: np.ndarray, same: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Stable partition by symbol inside the groups that hold several: the places touched, their turn and their sorted keys; None if there are none."""
    split = np.flatnonzero(same[1:] & (symbol[1:] != symbol[:-1])) + 1
    if not len(split):
        return None
    touched = np.zeros(number[-1] + 1, bool)
    touched[number[split]] = True
    at = np.flatnonzero(touched[number])
    key = number[at] * 512 + symbol[at]
    turn = np.argsort(key, kind="stable")
    return at, turn, key[turn]


def numbered(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted groups: whether a place has the group of the one before, and the number of its group."""
    same = np.concatenate([[False], group[1:] == group[:-1]])
    return same, np.cumsum(~same) - 1


def transformed(columns: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One shard's transform: for each column the symbols in the order of the suffixes behind them, and the order of the suffixes that begin with them."""
    same, number = numbered(group)
    order = np.arange(columns.shape[1])
    symbols, orders = np.empty_like(columns), np.empty(columns.shape, np.int32)
    for c in range(len(columns) - 1, -1, -1):
        symbols[c] = columns[c][order]
        if (turned := step(symbols[c], same, number)) is not None:
            at, turn, _ = turned
            order[at] = order[at][turn]
        orders[c] = order
    return symbols, orders


def merged(group: np.ndarray, before: np.ndarray, windows: np.ndarray, contexts: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """Contexts, sorted by group and aligned at their anchors. Returns for each its windows that the group holds twice."""
    rows = len(contexts)
    size = np.array([len(c) for c in contexts], np.int32)
    shift = (before.max() - before).astype(np.int32)
    width = int((shift + size).max())
    columns = np.zeros((rows, width), np.uint16)  # 0: outside a context
    for k, c in enumerate(contexts):
        columns[k, shift[k] : shift[k] + size[k]] = np.frombuffer(c, np.uint8)
        columns[k, shift[k] : shift[k] + size[k]] += 1
    columns = np.ascontiguousarray(columns.T)
    shard = (np.arange(rows) % shards).astype(np.uint8)
    members = [np.flatnonzero(shard == k) for k in range(min(shards, rows))]
    made = [transformed(columns[:, m], group[m]) for m in members]
    del columns
    symbols = np.concatenate([s for s, _ in made], 1)
    rank = np.concatenate([m[o] for m, (_, o) in zip(members, made, strict=True)], 1)
    del made
    same, number = numbered(group)
    from_shard = shard[np.lexsort((shard, group))]
    until = np.where(same, width, -1)  # where the common prefix with the place before ends
    repeated = np.zeros((width, rows), bool)
    symbol, row = np.empty(rows, np.uint16), np.empty(rows, np.int64)
    places = np.argsort(from_shard, kind="stable")  # the places of each shard's suffixes, in their order
    for c in range(width - 1, -1, -1):
        symbol[places] = symbols[c]
        if (turned := step(symbol, same, number)) is not None:
            at, turn, key = turned
            old = until[at]
            alike = np.flatnonzero(key[1:] == key[:-1]) + 1
            new = np.where(same[at], c, -1)
            if len(alike):
                low, high = turn[alike - 1] + 1, turn[alike] + 1
                pairs = np.stack([low, high], 1).ravel()
                new[alike] = np.minimum.reduceat(np.append(old, width), pairs)[::2]
            until[at] = new
            from_shard[at] = from_shard[at][turn]
            places = np.argsort(from_shard, kind="stable")
        if c <= width - length:
            hit = np.flatnonzero(until >= c + length)
            if len(hit):
                row[places] = rank[c]
                repeated[c, row[hit]] = True
                repeated[c, row[hit - 1]] = True
    return [np.flatnonzero(repeated[s : s + n, k]) for k, (s, n) in enumerate(zip(shift, windows, strict=True))]


def merge_contexts(length: int):
    """Over rows (grouped, origin, shift, before, windows, data) sorted by grouped: (origin, start, count) of repeated windows."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        found = merged(frame["grouped"].to_numpy(), frame["before"].to_numpy(np.int64), frame["windows"].to_numpy(np.int64), list(frame["data"]), length)
        out = []
        for origin, shift, places in zip(frame["origin"], frame["shift"], found, strict=True):
            if len(places):
                cut = np.flatnonzero(np.diff(places) != 1) + 1
                first = places[np.concatenate([[0], cut])]
                last = places[np.concatenate([cut, [len(places)]]) - 1]
                out += [(origin, int(a) + shift, int(b - a) + 1) for a, b in zip(first, last, strict=True)]
        return pd.DataFrame(out, columns=["origin", "start", "count"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, len(batch), 500):
                held.append(batch.iloc[at : at + 500])
                rows += len(held[-1])
                if rows >= MERGED:
                    frame = pd.concat(held)
                    last = (frame["grouped"] == frame["grouped"].iloc[-1]).to_numpy()
                    if not last.all():
                        yield work(frame[~last])
                    held, rows = [frame[last]], int(last.sum())
        if rows:
            yield work(pd.concat(held))

    return run


def divided(rows: DataFrame, length: int, group: int) -> tuple[DataFrame, DataFrame | None]:
    """rows (grouped, core, origin, shift, before, windows, data): groups of at most `group` rows, and the whole windows of the rest."""
    small: DataFrame | None = None
    while True:
        sizes = rows.groupBy("grouped").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = common.saved(rows.join(sizes, "grouped"), "repeat-groups")
        fits = rows.filter(F.col("n") <= group).drop("n")
        small = fits if small is None else small.unionByName(fits)
        large = rows.filter(F.col("n") > group).drop("n")
        if not large.limit(1).count():
            return small, None
        if not large.filter(F.col("core") < length).limit(1).count():
            return small, large
        half = F.ceil((F.lit(length) - F.col("core")) / 2).cast("int")
        whole = F.col("core") == length
        left = large.filter(~whole).withColumns({"windows": F.least(F.col("windows"), F.col("before") - half + 1), "before": F.col("before") - half, "core": F.col("core") + half})
        left = left.filter("windows > 0").withColumn("data", F.substring("data", F.lit(1), F.col("windows") - 1 + length))
        skip = F.greatest(F.lit(0), F.col("before") - half + 1)
        right = large.filter(~whole).withColumns({"shift": F.col("shift") + skip, "windows": F.col("windows") - skip, "before": F.col("before") - skip, "core": F.lit(length + 1) - half, "data": F.expr(f"substring(data, greatest(0, before - cast(ceil(({length} - core) / 2) as int) + 1) + 1)")})
        both = left.unionByName(right.filter("windows > 0").select(left.columns))
        both = both.withColumn("grouped", F.xxhash64("core", F.substring("data", F.col("before") + 1, F.col("core"))))
        rows = both.unionByName(large.filter(whole))


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text_key, spans (of bytes that a repeated string covers, in any order); texts without any are left out."""
    spark = common.bounded_batches(docs.sparkSession)
    texts = docs.select(common.text_key(text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                yield pd.DataFrame([(k, *x) for k, t in zip(part["key"], part["text"], strict=True) for x in anchors((t or "").encode("utf-8", "replace"), length, gram)], columns=["key", "at", "anchor", "first", "windows", "before"])

    long_enough = texts.filter(F.octet_length("text") >= length)
    base = long_enough.select("key", "text").mapInPandas(find, "key binary, at int, anchor array<long>, first array<int>, windows array<int>, before array<int>")
    base = common.saved(base.groupBy("key", "at").agg(F.first(F.struct("anchor", "first", "windows", "before")).alias("r")).select("key", "r.*"), "repeat-anchors")
    copies = common.saved(long_enough.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first(F.octet_length("text")).alias("size")), "repeat-texts")

    each = base.select("key", F.inline(F.arrays_zip("anchor", "first", "windows", "before")))
    often = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # written first, so that the join has plain shuffles on both sides and a hot anchor's rows can be split
    often = common.saved(often.select("anchor"), "repeat-often")
    wanted = each.join(often, "anchor").groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "windows", "before")).alias("w"))
    wanted = wanted.join(copies.select("key", "id"), "key").select("key", "id", *[F.col(f"w.{c}").alias(c) for c in ("anchor", "first", "windows", "before")])
    t = texts.select(F.col("key").alias("k"), F.col("id").alias("i"), "text")
    here = t.join(wanted, (t["k"] == wanted["key"]) & t["i"].eqNullSafe(wanted["id"])).select("key", "text", "anchor", "first", "windows", "before")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                part, out = batch.iloc[at : at + 100], []
                for key, text, *runs in part.itertuples(index=False):
                    raw = text.encode("utf-8", "replace")
                    for anchor, first, windows, before in zip(*(x.tolist() for x in runs), strict=True):
                        data = raw[first : first + windows - 1 + length]
                        out.append((key, anchor, first, windows, before, hashlib.blake2b(data, digest_size=16).digest(), data))
                        if len(out) == 4000:
                            yield pd.DataFrame(out, columns=COLUMNS)
                            out = []
                yield pd.DataFrame(out, columns=COLUMNS)

    rows = common.saved(here.mapInPandas(cut, "key binary, anchor long, first int, windows int, before int, digest binary, data binary"), "repeat-contexts")
    contexts = rows.groupBy("digest").agg(F.first(F.struct("anchor", "windows", "before", "data")).alias("r"), F.count(F.lit(1)).alias("n"))
    contexts = common.saved(contexts.select("digest", "n", "r.*"), "repeat-distinct")
    several = contexts.filter("n > 1").select(F.col("digest").alias("origin"), F.lit(0).alias("start"), F.col("windows").alias("count"))

    small, large = divided(contexts.select(F.col("anchor").alias("grouped"), F.lit(gram).alias("core"), F.col("digest").alias("origin"), F.lit(0).alias("shift"), "before", "windows", "data"), length, GROUP)
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = small.select("grouped", "origin", "shift", "before", "windows", "data").repartition(parts, "grouped").sortWithinPartitions("grouped", "origin", "shift")
    runs = several.unionByName(dealt.mapInPandas(merge_contexts(length), "origin binary, start int, count int"))
    if large is not None:
        windows = large.select("origin", F.col("shift").alias("start"), F.sha2("data", 256).alias("window"))
        twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        runs = runs.unionByName(windows.join(twice, "window").select("origin", "start", F.lit(1).alias("count")))

    met = rows.select("key", "first", "digest").join(runs, F.col("digest") == F.col("origin"))
    spans = met.select("key", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("start") + F.col("count") - 1 + length).alias("stop"))
    whole = copies.filter("n > 1").select("key", F.lit(0).alias("start"), F.col("size").alias("stop"))
    return spans.unionByName(whole).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


COLUMNS = ["key", "anchor", "first", "windows", "before", "digest", "data"]


def disjoint(spans) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, sorted."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((int(s["start"]), int(s["stop"])) for s in (spans if spans is not None else ())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def with_spans(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "__spans") -> DataFrame:
    """docs with a column spans_col, which must be new: null where nothing repeats."""
    if common.unused(docs, spans_col) != spans_col:
        raise ValueError(f"there is a column {spans_col}")
    key, found = common.unused(docs, "__key"), common.unused(docs, "__found")
    spans = repeated_spans(docs, length=length, id_col=id_col, text_col=text_col).select(F.col("key").alias(found), F.col("spans").alias(spans_col))
    return docs.withColumn(key, common.text_key(text_col)).join(spans, F.col(key) == F.col(found), "left").drop(key, found)


def measured(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, found in zip(texts, spans, strict=True):
        raw = (text or "").encode("utf-8", "replace")
        cut = disjoint(found)
        rows.append((len(raw), sum(b - a for a, b in cut), len(cut), hashlib.sha256(without(raw, cut)).hexdigest()))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def trimmed(marked: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "__spans") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the rows of with_spans()."""
    measure = F.pandas_udf(measured, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return marked.select(F.col(id_col).alias("doc_id"), measure(text_col, spans_col).alias("r")).select("doc_id", "r.*")


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with the repeated strings cut out of the text.

    A character that a span holds in part stays, so that the text remains valid UTF-8; a
    text without repeats is passed on as it is.
    """

    def shorten(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            if found is None:
                out.append(text)
                continue
            raw = text.encode("utf-8", "replace")
            inner = []
            for a, b in disjoint(found):
                while a < b and raw[a] & 0xC0 == 0x80:
                    a += 1
                while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                    b -= 1
                inner.append((a, b))
            out.append(without(raw, inner).decode("utf-8"))
        return pd.Series(out, dtype=object)

    spans = common.unused(docs, "__spans")
    marked = with_spans(docs, length=length, id_col=id_col, text_col=text_col, spans_col=spans)
    return marked.withColumn(text_col, F.pandas_udf(shorten, "string")(text_col, spans)).drop(spans)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    return trimmed(with_spans(docs))
