"""Resharding by minimum-cost flow (operator 7).

Spark counts the rows and bytes of every block, a block being the rows of one old shard
that fall in one size class. The driver sees those counts only: at most old shards x size
classes x SUBS numbers, whatever the input. It solves a minimum-cost flow from old shards
to new capacities in which a row that stays costs nothing and a row that leaves costs its
block's mean bytes, so the fewest bytes move. The solution cuts each block's rank range
into segments; Spark ranks the rows of each block and looks its segment up.

`rewrite_affected` then writes the files of the shards that gain or lose rows, and no others.

Two tables are broadcast, of at most old shards x size classes x SUBS rows (a size class is a
quarter of a doubling, so 16 old shards and texts up to 1 GB make 16 x 120 x 64 rows).

Law `rows`: capacities differ by one row at most. Defined results: a null text has no
bytes; null ids and repeated rows are rows like any other and get slots of their own; an
empty table gives no rows; of the columns only the id, the text and what `old_shard` names are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: A block's rows are ranked in so many parts, so that no task has to rank a whole block.
SUBS = 64


def min_cost_flow(arcs: list[tuple[int, int, int, float]], nodes: int, source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of a cheapest maximum flow: successive shortest paths with potentials."""
    to, left, cost, leaving = [], [], [], [[] for _ in range(nodes)]
    for a, b, capacity, price in arcs:
        for x, y, room, p in ((a, b, capacity, price), (b, a, 0, -price)):
            leaving[x].append(len(to))
            to.append(y), left.append(room), cost.append(p)
    potential = [0.0] * nodes
    while True:
        distance, via = [float("inf")] * nodes, [-1] * nodes
        distance[source] = 0.0
        heap = [(0.0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > distance[x]:
                continue
            for e in leaving[x]:
                if left[e] and (now := d + max(0.0, cost[e] + potential[x] - potential[to[e]])) < distance[to[e]] - 1e-12:
                    distance[to[e]], via[to[e]] = now, e
                    heapq.heappush(heap, (now, to[e]))
        if via[sink] < 0:
            return [left[e] for e in range(1, len(to), 2)]
        potential = [p + min(d, distance[sink]) for p, d in zip(potential, distance, strict=True)]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(left[e] for e in path)
        for e in path:
            left[e] -= push
            left[e ^ 1] += push


def plan_moves(blocks: dict[tuple[int, int], tuple[int, int]], capacities: list[int]) -> list[tuple[int, int, int, int, int]]:
    """blocks: (old shard, class) -> (rows, bytes). Returns segments (old shard, class, first rank, end rank, new shard).

    An old shard numbered beyond the new ones is emptied. Capacities must add up to the rows.
    """
    olds = sorted({o for o, _ in blocks})
    at = {o: 1 + i for i, o in enumerate(olds)}
    hub, new, sink = 1 + len(olds), 2 + len(olds), 2 + len(olds) + len(capacities)
    rows_of = defaultdict(int)
    for (o, _), (n, _) in blocks.items():
        rows_of[o] += n
    arcs = [(0, at[o], rows_of[o], 0.0) for o in olds]
    arcs += [(at[o], new + o, rows_of[o], 0.0) for o in olds if o < len(capacities)]
    leave = sorted(blocks)
    first_leave = len(arcs)
    arcs += [(at[o], hub, blocks[o, c][0], blocks[o, c][1] / max(1, blocks[o, c][0])) for o, c in leave]
    first_join = len(arcs)
    arcs += [(hub, new + j, room, 0.0) for j, room in enumerate(capacities)]
    arcs += [(new + j, sink, room, 0.0) for j, room in enumerate(capacities)]
    flow = min_cost_flow(arcs, sink + 1, 0, sink)
    joining = [[j, flow[first_join + j]] for j in range(len(capacities)) if flow[first_join + j]]
    segments = []
    for i, (o, c) in enumerate(leave):
        rank, moved = 0, flow[first_leave + i]
        while moved:
            j, room = joining[-1]
            take = min(moved, room)
            segments.append((o, c, rank, rank + take, j))
            rank, moved = rank + take, moved - take
            joining[-1][1] -= take
            if not joining[-1][1]:
                joining.pop()
        if rank < blocks[o, c][0]:
            segments.append((o, c, rank, blocks[o, c][0], o))
    return segments


class Plan(NamedTuple):
    """starts: (old shard, class, part, first rank); segments: (old shard, class, first rank, end rank, new shard, first slot)."""

    starts: list[tuple[int, int, int, int]]
    segments: list[tuple[int, int, int, int, int, int]]

    def touched(self) -> list[int]:
        """Numbers of the shards that gain or lose rows; the segments tell, no row is looked at."""
        return sorted({shard for o, _, lo, hi, j, _ in self.segments if o != j and lo < hi for shard in (o, j)})


def _sized(docs: DataFrame, old_shard: Column, id_col: str, text_col: str, carry: bool) -> DataFrame:
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(common.text_or_empty(text_col).cast("binary")).alias("text_crc32"),
        old_shard.cast("int").alias("old_shard"),
        F.xxhash64(F.col(text_col)).alias("tie"),
        *([F.col(text_col).alias("text")] if carry else []),
    )
    return base.withColumn("size_class", F.floor(F.log2("size") * 4).cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SUBS)).cast("int"))


def plan_reshard(docs: DataFrame, *, old_shard: Column, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> Plan:
    """Where the rows of every block go: one pass over docs that counts them, and the flow."""
    base = _sized(docs, old_shard, id_col, text_col, False)
    counted = base.groupBy("old_shard", "size_class", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
    blocks: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
    starts = []
    for r in sorted(counted, key=lambda r: (r.old_shard, r.size_class, r.part)):
        b = blocks[r.old_shard, r.size_class]
        starts.append((r.old_shard, r.size_class, r.part, b[0]))
        b[0] += r.n
        b[1] += r.bytes
    total = sum(n for n, _ in blocks.values())
    capacities = [total // shards + (j < total % shards) for j in range(shards)]
    used = [0] * shards
    segments = []
    for o, c, lo, hi, j in plan_moves({k: (n, b) for k, (n, b) in blocks.items()}, capacities) if total else []:
        segments.append((o, c, lo, hi, j, used[j]))
        used[j] += hi - lo
    return Plan(starts, segments)


def reshard(docs: DataFrame, *, old_shard: Column, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, plan: Plan | None = None) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, law, shard, slot, grown_shard for every row of docs; with carry also its text, as `text`.

    plan: what plan_reshard() gave for the same rows; without it, it is made here.
    """
    spark = docs.sparkSession
    plan = plan or plan_reshard(docs, old_shard=old_shard, shards=shards, id_col=id_col, text_col=text_col)
    start_type = "old_shard int, size_class int, part int, start long"
    segment_type = "old_shard int, size_class int, lo long, hi long, shard int, slot_base long"
    ranked = (
        _sized(docs, old_shard, id_col, text_col, carry)
        .withColumn("n", F.row_number().over(Window.partitionBy("old_shard", "size_class", "part").orderBy("doc_id", "text_crc32", "tie")))
        .join(F.broadcast(spark.createDataFrame(plan.starts, start_type)), ["old_shard", "size_class", "part"])
        .withColumn("rank", F.col("start") + F.col("n") - 1)
    )
    placed = ranked.join(F.broadcast(spark.createDataFrame(plan.segments, segment_type)), ["old_shard", "size_class"]).filter("rank >= lo AND rank < hi")
    return placed.select(
        "doc_id", "size", "text_crc32", "old_shard", F.lit("rows").alias("law"), "shard",
        (F.col("slot_base") + F.col("rank") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *(["text"] if carry else []),
    )


def affected(placed: DataFrame) -> list[int]:
    """Numbers of the new shards that gain or lose rows."""
    moved = placed.filter("old_shard <> shard").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    return sorted(r.shard for r in moved.collect())  # shard numbers only


def rewrite_affected(placed: DataFrame, path: str, touched: list[int] | None = None) -> list[int]:
    """Write the files of those shards that gain or lose rows, a folder shard=N for each, into path; returns their numbers.

    placed: what reshard() gives with carry=True; touched: their numbers where a plan tells them, else
    the rows are gone through once more to find them. The rows go with their places, so null and
    repeated ids are kept like any other, and no join is needed. Folders of other shards in
    path stay as they are; path must not be where the documents are read from; an old shard
    beyond the new ones is not written, its folder is left to the caller.
    """
    touched = affected(placed) if touched is None else touched
    rows = placed.filter(F.col("shard").isin(touched or [-1])).select("doc_id", "text", "slot", "shard")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return touched


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout keeps each source in one shard, so that one shard holds far too much.

    The affected shards are rewritten, and their rows are returned as read back from the files.
    """
    old = F.pmod(F.xxhash64(F.coalesce(F.col("source"), F.lit(""))), F.lit(16))
    docs = common.documents(spark, sf_dir)
    plan = plan_reshard(docs, old_shard=old)
    path = common.new_path(spark, "shard-files")
    touched = rewrite_affected(reshard(docs, old_shard=old, carry=True, plan=plan), path, plan.touched())
    stay = reshard(docs, old_shard=old, plan=plan).filter(~F.col("shard").isin(touched or [-1])).select("doc_id", "size", "text_crc32", "shard", "slot")
    if touched:
        files = spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
        size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
        read = files.select("doc_id", size.alias("size"), F.crc32(common.text_or_empty("text").cast("binary")).alias("text_crc32"), "shard", "slot")
        stay = read.unionByName(stay) if len(touched) < 16 else read
    return stay.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
