"""Toxicity scores from a character n-gram linear classifier with naive Bayes features (operator 1).

Features are the presences of hashed grams of 3 to 6 characters of the lower-cased text,
scaled by naive Bayes log-count ratios; a regularised logistic regression is fitted on them.
It is fitted on at most `sample` labelled rows (those of least hash, so the choice is stable)
and on the `features` grams that tell the labels apart best by the likelihood-ratio statistic;
grams are counted and ranked in Spark, so the driver receives that many counts and, for each
sampled row, one bit a gram (`sample` * `features` / 8 bytes in all). Every text is then
scored whole, in Spark tasks, against two tables of `BUCKETS` numbers.

Defined results: empty and null texts get the score of the intercept alone; where no row,
or rows of one label only, can be learned from, every score is that label's share (0 if
there are none); a null id is never held out and not learned from; repeated rows are scored
alike and, where sampled, count each; of the input's columns only the id and the text are
read; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 18
SHORTEST, LONGEST = 3, 6
SAMPLE = 4000
FEATURES = 8192
#: Rows that must hold a gram.
SUPPORT = 4
THRESHOLD = 0.3
#: Texts are hashed in stretches of so many characters, which overlap by a gram.
STRETCH = 1 << 15


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for null ids."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def grams(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the text's grams of characters."""
    seen = np.zeros(BUCKETS, bool)
    if text:
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
        for at in range(0, len(points), STRETCH):
            b = points[at : at + STRETCH + LONGEST - 1].copy()
            b[(b >= 9) & (b <= 13)] = 32
            h = np.full(len(b), 0x811C9DC5, np.uint32)
            for k in range(LONGEST):
                if k >= len(b):
                    break
                h = (h[: len(b) - k] ^ b[k:]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x85EBCA6B)
                if k + 1 >= SHORTEST:
                    seen[(h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)] = True
    return np.flatnonzero(seen).astype(np.int32)


def constant(share: float) -> tuple[np.ndarray, np.ndarray, float]:
    limit = np.clip(share, 1e-9, 1 - 1e-9)
    return np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), float(np.log(limit / (1 - limit)))


def fit(bits: np.ndarray, y: np.ndarray, ratio: np.ndarray, *, steps: int = 120, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and intercept from rows x grams of presences, by gradients over all rows."""
    x = bits.astype(np.float32)
    x *= ratio.astype(np.float32)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None] + np.float32(1e-9)
    w, bias = np.zeros(len(ratio)), np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        off = (1 / (1 + np.exp(-(x @ w.astype(np.float32) + bias))) - y) / len(y)
        g = (off.astype(np.float32) @ x) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
        bias -= off.sum()
    return w, float(bias)


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text and __label of at most `sample` labelled rows, those of least hash."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample)
    return docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("text", "__label")


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """Ratios and weights of all buckets, and the intercept."""
    common.bounded_batches(docs.sparkSession)
    rows = common.saved(sample_rows(docs, labels, label, sample, id_col=id_col, text_col=text_col), "toxicity-sample")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__label"), F.lit(0)).alias("toxic")).first()
    if size.toxic in (0, size.n):
        return constant(size.toxic / max(1, size.n))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["__label"], strict=True):
                counts[int(toxic != 0), grams(text)] += 1
        some = np.flatnonzero(counts.any(0))
        yield pd.DataFrame({"bucket": some, "p": counts[1, some], "q": counts[0, some]})

    sums = rows.mapInPandas(counted, "bucket int, p long, q long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).filter(F.col("p") + F.col("q") >= SUPPORT)
    toxic, clean = float(size.toxic), float(size.n - size.toxic)
    share = (F.col("p") + F.col("q")) / (toxic + clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    strength = part(F.col("p"), share * toxic) + part(F.col("q"), share * clean) + part(toxic - F.col("p"), (1 - share) * toxic) + part(clean - F.col("q"), (1 - share) * clean)
    best = sums.withColumn("strength", F.round(strength, 6)).orderBy(F.desc("strength"), "bucket").limit(features).collect()
    kept = np.array(sorted(r.bucket for r in best), np.int64)
    of = {r.bucket: (r.p, r.q) for r in best}
    ratio = np.array([np.log((of[b][0] + 1) / (toxic + 2)) - np.log((of[b][1] + 1) / (clean + 2)) for b in kept.tolist()])
    if not len(kept):
        return constant(toxic / size.n)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            bits = []
            for text in batch["text"]:
                seen[:] = False
                seen[grams(text)] = True
                bits.append(np.packbits(seen[kept]).tobytes())
            yield pd.DataFrame({"label": batch["__label"], "bits": bits})

    found = rows.mapInPandas(present, "label int, bits binary").collect()
    bits = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in found), np.uint8).reshape(len(found), -1), axis=1)[:, : len(kept)]
    w, bias = fit(bits, np.array([r.label != 0 for r in found], np.float64), ratio)
    ratios, weights = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32)
    ratios[kept], weights[kept] = ratio, w
    return ratios, weights, bias


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    sent = common.bounded_batches(docs.sparkSession).sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        ratio, weight, bias = sent.value
        product, square = ratio * weight, ratio * ratio
        z = np.empty(len(texts))
        for k, text in enumerate(texts):
            x = grams(text)
            z[k] = product[x].sum(dtype=np.float64) / (np.sqrt(square[x].sum(dtype=np.float64)) + 1e-9) + bias
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    return docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(score, "double")(F.col(text_col)).alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.documents(spark, sf_dir), common.labels(spark, sf_dir)
    model = train(docs, labels.filter(fold("doc_id", 4) != 2))
    out = scored(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
