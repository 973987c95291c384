"""Connected components as Spark joins (helper of the near-duplicate operator)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common


def ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, its smaller end first, without loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def jumped(hooks: DataFrame) -> DataFrame:
    """(node, label) with each label replaced by that label's own, if it has one."""
    onward = hooks.select(F.col("node").alias("label"), F.col("label").alias("onward"))
    return hooks.join(onward, "label", "left").select("node", F.coalesce("onward", "label").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, component): the least node that can be reached.

    Each round hooks every node to its least neighbour, if that is smaller, follows the hooks
    to their roots by pointer jumping, and goes on with the edges between roots alone, so the
    graph shrinks from round to round and so does the work. Every step is written to the
    shared folder; whether anything is left is counted while it is written.
    """
    left, rounds = common.saved(ordered(edges), "edges"), []
    while True:
        hooks = common.saved(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "hooks")
        while True:
            longer = Observation()
            further = hooks.select(F.col("node").alias("label"), F.lit(True).alias("hooked"))
            far = jumped(jumped(hooks)).join(further, "label", "left").observe(longer, F.count("hooked").alias("n"))
            hooks = common.saved(far.select("node", "label"), "hooks")
            if not longer.get["n"]:  # all labels are roots
                break
        rounds.append(hooks)
        ends = left
        for end in ("a", "b"):
            root = hooks.select(F.col("node").alias(end), F.col("label").alias("root"))
            ends = ends.join(root, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        more = Observation()
        left = common.saved(ordered(ends).observe(more, F.count(F.lit(1)).alias("n")), "edges")
        if not more.get["n"]:
            break
    labels = rounds.pop()
    while rounds:
        after = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        earlier = rounds.pop()
        labels = earlier.join(after, "label", "left").select("node", F.coalesce("last", "label").alias("label")).unionByName(labels)
    return common.saved(labels.unionByName(labels.select(F.col("label").alias("node"), "label")).distinct().withColumnRenamed("label", "component"), "labels")
