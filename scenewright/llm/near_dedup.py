"""Near-duplicate classes by SetSketch registers (operator 5).

Each document's set of word shingles is summed up by `M` SetSketch registers: truncated,
exponentially spaced minima of one exponential variable a register, K = floor(1 - log_b x),
which merge by taking the larger register and agree with a probability near the Jaccard
similarity; with b near 1 unrelated sets rarely agree by chance. Equal sets become one node.
Bands of `ROWS` registers deal the nodes into buckets; within a bucket the similarity of
pairs is estimated jointly, by likelihood over how many registers are larger, smaller and
equal at the known set sizes. A pair is plausible if it shares `LEAST` registers and its set
sizes allow the similarity asked for; the estimate only says which pairs are tried first.

Each bucket gives a maximum spanning forest over its plausible pairs, so a group of n copies
gives n - 1 pairs and not n * n. Buckets above `BLOCK` nodes are divided into blocks, each
with the `HUBS` nodes of least hash of its bucket, which tie the blocks together. Where a
divided bucket still falls into several clusters, nodes of different clusters are compared as
well (`across`): only pairs of blocks that hold different clusters meet, and only pairs that
join clusters leave the task. So the ends of every plausible pair are in one cluster.

Pairs are confirmed on full sets, the best of each node first. A link can hide behind a
forest pair that proves false: where a cluster falls into several classes, all its sets of
different classes are compared, again `across` blocks, by matrix products, and only links
that join classes leave the task. A cluster that is one class, as groups of copies are, costs
nothing there.

At similarity 0.8 a pair shares no bucket with probability 5e-8 and fewer than `LEAST`
registers with probability under 1e-6.

Defined results: a null text or one without words has an empty set, no links and is kept;
rows with one id count as one document; rows with a null id keep their own null class; empty
tables give no rows; of the input's columns only the id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import components
from .shingles import mixed, shingle_set

M = 128
ROWS = 4
B = 1.001
A = 20.0
TOP = 65_534
#: Equal registers of a plausible pair: at similarity 0.8 there are 102 with a deviation of 4.5.
LEAST = 78
BLOCK = 1024
HUBS = 16
#: Nodes of a block whose full sets are compared.
SET_BLOCK = 512
WORDS = 4
U32 = np.uint32
_seed = mixed(np.arange(1, 2 * M + 1, dtype=np.uint64))
FLIP = (_seed[:M] >> np.uint64(32)).astype(U32)
FACTOR = (_seed[M:] >> np.uint64(32)).astype(U32) | U32(1)


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """values: 64-bit elements of non-empty sets laid end to end from starts on. Returns sets x M registers."""
    small = (values ^ (values >> np.uint64(32))).astype(U32)
    out = np.empty((len(starts), M), U32)
    for i in range(M):
        h = small ^ FLIP[i]
        h *= FACTOR[i]
        h ^= h >> U32(16)
        h *= U32(0x85EBCA6B)
        h ^= h >> U32(13)
        out[:, i] = np.minimum.reduceat(h, starts)
    x = -np.log1p(-(out + 0.5) / 4294967296.0) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, TOP + 1).astype("<u2")


def sketched(docs: DataFrame, *, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest, registers (null for empty sets) of every row."""
    common.bounded_batches(docs.sparkSession)

    def sketch(texts: pd.Series) -> pd.DataFrame:
        out, at = [], 0
        while at < len(texts):
            sets, held = [], 0
            for text in texts.iloc[at:]:
                sets.append(shingle_set(text, words))
                held += len(sets[-1])
                if held > 100_000:
                    break
            at += len(sets)
            size = np.array([len(s) for s in sets])
            some = np.flatnonzero(size)
            rows: list[bytes | None] = [None] * len(sets)
            if len(some):
                starts = np.concatenate([[0], np.cumsum(size[some])[:-1]])
                for k, r in zip(some, registers(np.concatenate([sets[k] for k in some]), starts), strict=True):
                    rows[k] = r.tobytes()
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            out.append(pd.DataFrame({"n_shingles": size, "digest": digest, "registers": rows}))
        return pd.concat(out) if out else pd.DataFrame({"n_shingles": [], "digest": [], "registers": []})

    made = F.pandas_udf(sketch, "n_shingles long, digest binary, registers binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), made(F.col(text_col)).alias("s")).select("doc_id", "s.*")


def estimated(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarities, given register comparisons and set sizes: golden-section search, all pairs at once."""
    larger, smaller, equal = (x.astype(np.float64) for x in (larger, smaller, equal))
    u = n_a / (n_a + n_b)
    v = 1 - u
    scale, log_b = (B - 1) / B, np.log(B)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p = -np.log1p(-np.maximum(u - v * j, 1e-9) * scale) / log_b
        q = -np.log1p(-np.maximum(v - u * j, 1e-9) * scale) / log_b
        return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-9))

    low, high = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(16):
        c, d = high - g * (high - low), low + g * (high - low)
        left = likelihood(c) > likelihood(d)
        high, low = np.where(left, d, high), np.where(left, low, c)
    return (low + high) / 2


def alike_in_size(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m elements can have a similarity of percent."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def compared(regs: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Estimates of the pairs (i, j), in pieces of bounded memory; -1 where a pair is not plausible."""
    out = np.full(len(i), -1.0)
    for at in range(0, len(i), 100_000):
        a, b = i[at : at + 100_000], j[at : at + 100_000]
        x, y = regs[a], regs[b]
        equal = (x == y).sum(1)
        near = np.flatnonzero((equal >= LEAST) & alike_in_size(n[a], n[b], percent))
        if len(near):
            larger = (x[near] > y[near]).sum(1)
            out[at + near] = estimated(larger, M - equal[near] - larger, equal[near], n[a[near]], n[b[near]])
    return out


def agreement(regs: np.ndarray) -> np.ndarray:
    """How many registers each two rows share."""
    equal = np.zeros((len(regs), len(regs)), np.uint8)
    for column in np.ascontiguousarray(regs.T):
        equal += column[:, None] == column[None, :]
    return equal


def spanning(regs: np.ndarray, n: np.ndarray, percent: int, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Maximum spanning forest (Prim) over the plausible pairs of sets of n elements; rows with one label count as tied already."""
    equal, size = agreement(regs), len(regs)
    any_pair = alike_in_size(n.min(), n.max(), percent)
    tied = M + 1

    def shared(k: int) -> np.ndarray:
        row = equal[k].astype(np.int16)
        if not any_pair:
            row = np.where(alike_in_size(n, n[k], percent), row, 0)
        return row if label is None else np.where(label == label[k], tied, row)

    best, via = shared(0), np.zeros(size, np.int64)
    best[0] = -1
    left, right = [], []
    for _ in range(size - 1):
        now = int(np.argmax(best))
        if LEAST <= best[now] < tied:
            left.append(via[now]), right.append(now)
        row, outside = shared(now), best >= 0
        better = outside & (row > best)
        best[better], via[better] = row[better], now
        best[now] = -1
    return np.array(left, np.int64), np.array(right, np.int64)


def by_bucket(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole buckets from a stream that is sorted by columns."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[columns].to_numpy()
        last = np.flatnonzero((keys != keys[-1]).any(1))
        cut = last[-1] + 1 if len(last) else 0
        if held and (held[-1][columns].iloc[-1].to_numpy() != keys[0]).any():
            yield pd.concat(held)
            held = []
        if cut:
            yield pd.concat([*held, batch.iloc[:cut]])
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held)


def forests(percent: int, columns: list[str]):
    """Over rows (columns, node, registers, n_shingles, perhaps label) sorted by columns: a spanning forest (a, b, estimate) of each group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_bucket(batches, columns):
            keys = frame[columns].to_numpy()
            edge = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            start, stop = np.concatenate([[0], edge]), np.concatenate([edge, [len(frame)]])
            regs = np.frombuffer(b"".join(frame["registers"]), "<u2").reshape(len(frame), M)
            n, node = frame["n_shingles"].to_numpy(), frame["node"].to_numpy()
            label = frame["label"].to_numpy() if "label" in frame else None
            two = start[stop - start == 2]
            if label is not None:
                two = two[label[two] != label[two + 1]]
            pairs = [(two, two + 1)]
            for s, e in zip(start, stop, strict=True):
                if e - s > 2:
                    a, b = spanning(regs[s:e], n[s:e], percent, None if label is None else label[s:e])
                    pairs.append((a + s, b + s))
            i, j = (np.concatenate([p[k] for p in pairs]).astype(np.int64) for k in range(2))
            est = compared(regs, n, i, j, percent)
            good = (est >= 0) & (node[i] != node[j])
            a, b = node[i[good]], node[j[good]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "estimate": est[good]})

    return run


EDGES = "a long, b long, estimate double"


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    parts = max(12, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "node")


def blocks_of(n, block: int):
    return F.ceil(n / block).cast("int")


def across(rows: DataFrame, group: str, block: int) -> DataFrame:
    """rows (group, node, label) repeated so that nodes of different labels meet: with i and j, a pair of blocks of the group.

    A label of more than half a block has blocks of its own, which never meet each other;
    smaller labels share blocks. So the rows of one large class go out once for each block
    of other classes, whatever its own size.
    """
    sizes = rows.groupBy(group, "label").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") <= block // 2
    shares = sizes.groupBy(group).agg(blocks_of(F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)), block).alias("shared"), F.sum(F.when(small, 0).otherwise(blocks_of(F.col("n"), block))).cast("int").alias("own"))
    own = sizes.filter(~small).withColumn("parts", blocks_of(F.col("n"), block))
    own = own.withColumn("first", (F.sum("parts").over(Window.partitionBy(group).orderBy("label")) - F.col("parts")).cast("int")).select(group, "label", "parts", "first")
    placed = rows.join(shares, group).join(own, [group, "label"], "left")
    alone = F.col("parts").isNotNull()
    mine = F.when(alone, F.col("shared") + F.col("first") + F.pmod(F.xxhash64("node"), "parts")).otherwise(F.pmod(F.xxhash64("label"), "shared")).cast("int")
    every = F.sequence(F.lit(0), F.col("shared") + F.col("own") - 1)
    others = F.when(alone, F.filter(every, lambda k: (k < F.col("shared") + F.col("first")) | (k >= F.col("shared") + F.col("first") + F.col("parts")))).otherwise(every)
    met = placed.withColumn("mine", mine).withColumn("other", F.explode(others))
    return met.select(*rows.columns, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def propose(members: DataFrame, reps: DataFrame, percent: int, any_large: bool) -> DataFrame:
    """members (key, node, in_bucket) -> distinct plausible pairs (a, b, estimate) that tie each bucket's plausible pairs together."""
    sketches = reps.select("node", "registers", "n_shingles")
    blocks = blocks_of(F.col("in_bucket"), BLOCK)
    rows = members.select("key", "node", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("i"))
    large = members.filter(F.col("in_bucket") > BLOCK)
    if any_large:
        drawn = F.pmod(F.xxhash64("node"), F.floor(F.col("in_bucket") / (4 * HUBS)) + 1) == 0
        hubs = large.filter(drawn).groupBy("key").agg(F.first("in_bucket").alias("in_bucket"), F.slice(F.array_sort(F.collect_set("node")), 1, HUBS).alias("hubs"))
        hubs = hubs.select("key", F.explode("hubs").alias("node"), "in_bucket").select("key", "node", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"))
        rows = rows.unionByName(hubs)
    tree = dealt(rows.join(sketches, "node"), "key", "i").mapInPandas(forests(percent, ["key", "i"]), EDGES)
    best = F.max("estimate").alias("estimate")
    tree = common.saved(tree.groupBy("a", "b").agg(best), "near-forest")
    if not any_large:
        return tree
    parted = labelled(large.select("key", "node"), "node", "label", components(tree))
    several = parted.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    met = across(common.saved(parted.join(several, "key"), "near-parted"), "key", BLOCK)
    joining = dealt(met.join(sketches, "node"), "key", "i", "j").mapInPandas(forests(percent, ["key", "i", "j"]), EDGES)
    return common.saved(tree.unionByName(joining).groupBy("a", "b").agg(best), "near-forest")


def shared_shingles(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections, by products of membership matrices over the shingles that occur twice."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.cumsum(times > 1) - 1
    keep = times[code] > 1
    row, code = row[keep], often[code[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(often[-1]) + 1 if len(often) else 0, columns):
        here = (code >= at) & (code < at + columns)
        held = np.zeros((len(sets), columns), np.float32)
        held[row[here], code[here] - at] = 1
        out += held @ held.T
    return out


def missing_links(numerator: int, denominator: int):
    """Over sorted rows (cluster, i, j, node, label, members): links (a, b) between labels (la, lb), enough to join them."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in frame["members"]]
        size, component, node = np.array([len(s) for s in sets], np.float32), frame["label"].to_numpy(), frame["node"].to_numpy()
        both = shared_shingles(sets)
        linked = (denominator * both >= numerator * (size[:, None] + size[None, :] - both)) & (component[:, None] < component[None, :])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        out = []
        for a, b in zip(*np.nonzero(linked), strict=True):
            x, y = find(component[a]), find(component[b])
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((min(node[a], node[b]), max(node[a], node[b]), component[a], component[b]))
        return pd.DataFrame(out, columns=["a", "b", "la", "lb"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frames in by_bucket(batches, ["cluster", "i", "j"]):
            for _, frame in frames.groupby(["cluster", "i", "j"], sort=False):
                yield work(frame)

    return run


def labelled(df: DataFrame, node: str, out: str, labels: DataFrame) -> DataFrame:
    """df with the component of a node as a column; nodes without one are their own."""
    found = labels.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    return df.join(found, F.col(node) == F.col("__n"), "left").withColumn(out, F.coalesce("__c", node)).drop("__c", "__n")


def confirm(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """pairs (a, b) with their link decided on full sets: (a, b, linked)."""
    joined = pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("members").alias("right")), "b").join(sets.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["left"], batch["right"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common_size = int((both[1:] == both[:-1]).sum())
                linked.append(denominator * common_size >= numerator * (len(both) - common_size))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    return joined.select("a", "b", "left", "right").mapInPandas(run, "a long, b long, linked boolean")


def near_duplicates(docs: DataFrame, *, percent: int = 80, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    base = common.saved(sketched(docs, words=words, id_col=id_col, text_col=text_col), "near-sketches")
    reps = common.saved(
        base.filter("registers IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")),
        "near-nodes",
    )
    bands = reps.select("node", F.posexplode(F.array(*[F.substring("registers", 2 * ROWS * k + 1, 2 * ROWS) for k in range(M // ROWS)])).alias("band", "value"))
    bands = bands.select("node", F.xxhash64("band", "value").alias("key"))
    counts = bands.groupBy("key").agg(F.count(F.lit(1)).alias("in_bucket")).filter("in_bucket > 1")
    large = Observation()
    # never broadcast: Spark takes the bands for no larger than the nodes, of which each has M / ROWS
    shared = bands.join(counts.hint("merge"), "key").select("key", "node", "in_bucket")
    shared = common.saved(shared.observe(large, F.count_if(F.col("in_bucket") > BLOCK).alias("n")), "near-buckets")
    tree = propose(shared, reps, percent, bool(large.get["n"]))
    involved = tree.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                yield pd.DataFrame({"node": part["node"], "members": [shingle_set(t, words).tobytes() for t in part["text"]]})

    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    # one way at every size: texts meet the nodes by a shuffle
    sets = texts.join(involved.hint("merge"), "node", "left_semi").mapInPandas(gather, "node long, members binary")
    sets = common.saved(sets, "near-sets")

    ends = tree.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "b", "a"), F.struct(F.col("b").alias("node"), "b", "a"))).alias("e"), "estimate").select("e.*", "estimate")
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("estimate", -F.col("a"), -F.col("b"))).alias("e")).select("e.a", "e.b").distinct()
    linked = common.saved(confirm(best, sets, percent, 100), "near-judged")
    labels = components(linked.filter("linked"))

    # clusters of plausible pairs that fell into several classes: all pairs of different classes, on full sets
    parted = labelled(labelled(tree, "a", "la", labels), "b", "lb", labels).filter("la <> lb")
    several = Observation()
    parted = common.saved(parted.select("la", "lb").observe(several, F.count(F.lit(1)).alias("n")), "near-parted")
    if several.get["n"]:
        clusters = components(parted.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("node").alias("label"), F.col("component").alias("cluster"))
        everyone = labelled(involved, "node", "label", labels).join(clusters, "label").select("cluster", "node", "label")
        everyone = common.saved(everyone, "near-clusters")
        # two lone nodes whose pair was judged need no second look
        whole = everyone.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter("n > 2").select("cluster")
        met = across(everyone.join(whole, "cluster"), "cluster", SET_BLOCK)
        more = dealt(met.join(sets, "node"), "cluster", "i", "j").mapInPandas(missing_links(percent, 100), "a long, b long, la long, lb long")
        found = Observation()
        more = common.saved(more.observe(found, F.count(F.lit(1)).alias("n")), "near-links")
        if found.get["n"]:
            new = components(more.select(F.col("la").alias("a"), F.col("lb").alias("b")))
            labels = labelled(labelled(involved, "node", "label", labels), "label", "component", new).select("node", "component")

    nodes = labelled(reps.select("digest", "node"), "node", "component", labels).select("digest", "component")
    found = base.select("doc_id", "n_shingles", "digest").join(nodes, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, *, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns, whatever these are called."""
    gone = common.unused(docs, "__gone")
    found = near_duplicates(docs, words=words, id_col=id_col, text_col=text_col).filter("NOT kept").select(F.col("doc_id").alias(gone))
    return docs.join(found, docs[id_col] == F.col(gone), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))
