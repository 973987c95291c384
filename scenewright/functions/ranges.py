"""Joins on ranges and numbering, arranged so that one large group is no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dyadic(start: Column, stop: Column) -> Column:
    """[start, stop] as an array of (level, block) without overlap: block b of level k holds b * 2**k to (b + 1) * 2**k - 1.

    At level k the numbers left are the blocks from ceil(start / 2**k) up to floor((stop + 1) / 2**k);
    an odd block at either end has no parent inside the span and is taken. So a span of n
    numbers gives at most 2 log2(n) blocks.
    """
    start, stop = start.cast("long"), stop.cast("long")
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(stop - start + 2, F.lit(2)))).cast("int"))

    def taken(k: Column) -> Column:
        low = F.call_function("shiftright", start + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k)
        high = F.call_function("shiftright", stop + 1, k)
        block = lambda odd, b: F.when((low < high) & (F.abs(odd % 2) == 1), F.struct(k.cast("int").alias("level"), b.alias("block")))
        return F.filter(F.array(block(low, low), block(high, high - 1)), lambda x: x.isNotNull())

    return F.flatten(F.transform(levels, taken))


def range_join(points: DataFrame, spans: DataFrame, keys: list[str], point: str, start: str, stop: str, *, how: str = "inner") -> DataFrame:
    """points joined with the spans of the same keys that hold them (start <= point <= stop; whole numbers).

    A span is repeated for its dyadic blocks, at most 2 log2(length) of them, a point for the
    levels that blocks were taken from; the range becomes an equality on (keys, level, block),
    by which a point meets a span once. Spans with an end before their start or a null hold nothing.
    how: inner, left_semi or left_anti.
    """
    held = spans.filter(F.col(start) <= F.col(stop)).withColumn("__d", F.explode(dyadic(F.col(start), F.col(stop))))
    # the levels in use are at most 64 numbers, in one row
    levels = held.agg(F.collect_set("__d.level").alias("__levels"))
    if how != "inner":
        asked = points.select(*keys, point).distinct()
        met = range_join(asked, spans.select(*keys, start, stop), keys, point, start, stop).select(*keys, point).distinct()
        return points.join(met, [*keys, point], how).select(points.columns)
    at = points.crossJoin(F.broadcast(levels)).withColumn("__level", F.explode("__levels")).drop("__levels")
    left = at.withColumn("__block", F.expr(f"shiftright(cast(`{point}` AS bigint), __level)")).alias("p")
    right = held.withColumns({"__level": F.col("__d.level"), "__block": F.col("__d.block")}).drop("__d").alias("s")
    condition = (F.col("p.__level") == F.col("s.__level")) & (F.col("p.__block") == F.col("s.__block"))
    for k in keys:
        condition = condition & (F.col(f"p.{k}") == F.col(f"s.{k}"))
    kept = [F.col(f"p.`{c}`") for c in points.columns] + [F.col(f"s.`{c}`") for c in spans.columns if c not in keys]
    return left.join(right, condition).select(kept)


def numbered(df: DataFrame, group: str, order: str, out: str, *, width: int = 4096) -> DataFrame:
    """df with out = 1, 2, ... within group, in order of the whole number `order` (ties: any order among themselves).

    Rows are counted by stretches of `order` first, so that ranking works on a stretch of a
    group and never on a whole large group.
    """
    staged = df.withColumn("__stretch", F.floor(F.col(order) / width))
    sums = staged.groupBy(group, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(group).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(group, "__stretch", F.coalesce(before, F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(group, "__stretch").orderBy(order))
    return staged.join(sums, [group, "__stretch"]).withColumn(out, (rank + F.col("__before")).cast("int")).drop("__stretch", "__before")


def in_order(df: DataFrame, keys: list[str], at: list[str], then: list[str | Column] | None = None, *, take: str, rank: str | None = None, previous: str | None = None, following: str | None = None, width: int = 4096) -> DataFrame:
    """df with its rank within keys and `take` of the rows before and after it, in the order of `at`, then of `then` and `take`, ascending.

    at: whole numbers. The last of them is cut into stretches of `width`; a row is ranked among the rows
    of its stretch, and counts, first and last rows of the stretches tell the rest. No task orders a whole large
    group, unless all its rows are at one place. Null keys are a group like any other.
    """
    within = [*keys, *at[:-1], "__stretch"]
    staged = df.withColumn("__stretch", F.floor(F.col(at[-1]) / width))
    order = [*at, *(then or []), take]
    by = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    # as structs, so that the edge of a stretch is told from a null in it
    each = staged.groupBy(*within).agg(F.count(F.lit(1)).alias("__n"), F.min_by(F.struct(take), by).alias("__first"), F.max_by(F.struct(take), by).alias("__last"))
    stretches = Window.partitionBy(*keys).orderBy(*at[:-1], "__stretch")
    before = F.coalesce(F.sum("__n").over(stretches.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = each.select(*[F.col(c).alias(f"__e{i}") for i, c in enumerate(within)], before.alias("__before"), F.lag("__last").over(stretches).alias("__left"), F.lead("__first").over(stretches).alias("__right"))
    same = F.lit(True)
    for i, c in enumerate(within):
        same = same & F.col(c).eqNullSafe(F.col(f"__e{i}"))
    inner = Window.partitionBy(*within).orderBy(*order)
    out = staged.join(edges, same)
    found = {}
    if rank:
        found[rank] = (F.row_number().over(inner) + F.col("__before")).cast("int")
    if previous:
        found[previous] = F.coalesce(F.lag(F.struct(take)).over(inner), "__left")[take]
    if following:
        found[following] = F.coalesce(F.lead(F.struct(take)).over(inner), "__right")[take]
    return out.select(*[F.col(c) for c in df.columns if c not in found], *[v.alias(c) for c, v in found.items()])


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")
