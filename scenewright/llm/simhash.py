"""Near-duplicate classes by SimHash fingerprints and deletion-variant signatures (operator 13).

A fingerprint has 64 bits: bit k is set where more than half of the XXH64 values of the
text's word shingles, repeats included, have it set. Two fingerprints are linked if they
differ in at most two bits.

The fingerprint is cut into `SEGMENTS` = 2 halves, so that of two differing bits one half
holds at most one. Each half is indexed under its 32 one-wildcard variants (the half with
one bit masked): halves that differ in at most one bit share a variant. An equality join on
the variant brings candidates together and the number of differing bits is then counted.
All of it runs on distinct fingerprints, each with its least document, so copies cost nothing.

Variants that more than `BUCKET` fingerprints share (large families of near copies) are not
compared pair by pair: their fingerprints are indexed once more with the whole fingerprint as
one segment, under the 64 forms with one bit turned and as they are. Two of them share such
a form exactly if they differ in at most two bits, no form has more than 65 of them, and
all that share a form are linked, so a star per form holds every link of the family. So no group is larger than
65 rows, whatever the family, and no link is lost.

Defined results: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; with fewer words than a shingle takes, the whole sequence is one;
rows of one id stay rows of their own; rows with a null id have a null class, tie nothing
together and are kept; an empty table gives no rows; of the input's columns only the id and
the text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

SEED = 42
WORDS = 3
SEGMENTS, WIDTH = 2, 32
DISTANCE = 2
#: Fingerprints of one variant that are compared pair by pair.
BUCKET = 16
#: Hashes whose bits are counted at once.
BLOCK = 1 << 17
LOWERED = bytes.maketrans(common.UPPER.encode(), common.LOWER.encode())


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of so many words, repeats included; of the whole sequence where there are fewer; none without words."""
    w = (text or "").encode("utf-8", "replace").translate(LOWERED).split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)], np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(w[k:] for k in range(words)), strict=False)
    return np.fromiter((digest(joined(s), SEED) for s in shingles), np.uint64, len(w) - words + 1)


def bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def majorities(sets: list[np.ndarray]) -> np.ndarray:
    """Signed 64-bit fingerprints of sets of hashes, zero for an empty one."""
    ones, size = np.zeros((len(sets), 64), np.int64), np.array([len(s) for s in sets], np.int64)
    at = 0
    while at < len(sets):
        if size[at] > BLOCK:
            for k in range(0, size[at], BLOCK):
                ones[at] += bits(sets[at][k : k + BLOCK]).sum(0, dtype=np.int64)
            at += 1
            continue
        end, held = at, 0
        while end < len(sets) and held + size[end] <= BLOCK:
            held += size[end]
            end += 1
        some = at + np.flatnonzero(size[at:end])
        if len(some):
            starts = np.concatenate([[0], np.cumsum(size[some])[:-1]])
            ones[some] = np.add.reduceat(bits(np.concatenate([sets[k] for k in some])), starts, axis=0, dtype=np.int32)
        at = end
    return np.packbits(2 * ones > size[:, None], axis=1).view(">i8").ravel().astype(np.int64)


def fingerprint(texts: Column, words: int = WORDS) -> Column:
    def run(batch: pd.Series) -> pd.Series:
        out, sets, held = [], [], 0
        for text in batch:
            sets.append(shingle_hashes(text, words))
            held += len(sets[-1])
            if held > 4 * BLOCK:
                out.append(majorities(sets))
                sets, held = [], 0
        return pd.Series(np.concatenate([*out, majorities(sets)]) if out or sets else np.zeros(0, np.int64))

    return F.pandas_udf(run, "long")(texts)


def variants(nodes: DataFrame) -> DataFrame:
    """(fp, node) -> a row (key, fp, node) for each half and masked bit."""
    spread = nodes.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * WIDTH - 1))))
    half = F.expr(f"shiftrightunsigned(fp, {WIDTH} * cast(v div {WIDTH} AS int)) & {(1 << WIDTH) - 1}L")
    masked = half.bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(1L, v % {WIDTH})")))
    return spread.select(F.expr(f"shiftleft(cast(v AS bigint), {WIDTH})").bitwiseOR(masked).alias("key"), "fp", "node")


def links(nodes: DataFrame) -> DataFrame:
    """nodes (fp, node), fp distinct -> pairs (a, b) of nodes that tie together all whose fingerprints differ in at most two bits."""
    indexed = variants(nodes)
    sizes = indexed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # never broadcast: Spark takes the variants for no larger than the fingerprints, of which each has 64
    shared = common.saved(indexed.join(sizes.hint("merge"), "key"), "simhash-variants")
    few = shared.filter(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list(F.struct("fp", "node")).alias("m"))
    verified = F.expr(
        f"""flatten(transform(m, (x, i) -> transform(
              filter(slice(m, i + 2, size(m)), y -> bit_count(x.fp ^ y.fp) <= {DISTANCE}), y -> struct(least(x.node, y.node) AS a, greatest(x.node, y.node) AS b))))"""
    )
    pairs = few.select(F.explode(verified).alias("p")).select("p.a", "p.b")
    family = shared.filter(F.col("n") > BUCKET).select("fp", "node").distinct()
    turned = family.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(64))))
    turned = turned.select(F.expr("CASE WHEN v < 64 THEN fp ^ shiftleft(1L, v) ELSE fp END").alias("key"), "node")
    stars = turned.groupBy("key").agg(F.collect_set("node").alias("m")).filter("size(m) > 1").select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
    return pairs.unionByName(stars.filter("a < b")).distinct()


def near_duplicates(docs: DataFrame, *, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least id that can be reached), kept for every row of docs."""
    common.bounded_batches(docs.sparkSession)
    base = common.saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    nodes = common.saved(base.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    labels = components(links(nodes)).filter("node <> component")
    moved = nodes.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    found = base.join(moved, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))
