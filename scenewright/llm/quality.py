"""Quality scores by positive-unlabelled learning (operator 4).

Trusted positives are labelled rows of good quality; unlabelled text is any document. The
class prior is estimated as the share of good rows among the labelled ones that may be
learned from. A logistic model over shape statistics of the whole text minimises the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

stepping back along the second term's gradient while that term is below zero. At most
`sample` positives and as many unlabelled texts are fitted on (those of least hash); every
text is scored whole, in Spark tasks.

Defined results: empty and null texts have all statistics zero and are scored like any
text; without positives every score is the prior (0 where there are no labels); a null id is
never held out and not learned from; repeated rows are scored alike and, where sampled, count
each; the columns of the input are passed on beside the score, whose name is a parameter;
empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .toxicity import THRESHOLD, fold, sample_rows

SAMPLE = 6000
FEATURES = 26
_kind = np.zeros(256, np.int64)
_kind[[9, 10, 11, 12, 13, 32]] = 1
_kind[48:58] = 2
_kind[65:91] = 3
_kind[97:123] = 4
_kind[128:] = 5
_kind[[46, 44]] = 6
_kind[33] = 7
_kind[124] = 8
_kind[[35, 36, 37, 38, 42]] = 9
KIND = _kind
#: Bytes compressed at once to see how much repeats.
STRETCH = 1 << 16


def statistics(text: str | None) -> np.ndarray:
    """Shape of a text: lengths, kinds of characters, repetition of words, neighbours and lines."""
    raw = (text or "").encode("utf-8", "replace")
    f = np.zeros(FEATURES)
    if not raw:
        return f
    n = len(raw)
    f[:10] = np.bincount(KIND[np.frombuffer(raw, np.uint8)], minlength=10) / n
    words = raw.split()
    count = len(words)
    f[10] = np.log1p(n)
    if not count:
        return f
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size = np.fromiter(map(len, words), np.int64, count)
    seen = Counter(words)
    f[11] = size.mean()
    f[12] = size.std()
    f[13] = len(seen) / count
    f[14] = seen.most_common(1)[0][1] / count
    f[15] = sum(map(bytes.__eq__, words[1:], words)) / count
    f[16] = len(set(lines)) / len(lines)
    f[17] = np.log1p(count / len(lines))
    f[18] = np.log1p(len(lines))
    packed = sum(len(zlib.compress(raw[k : k + STRETCH], 1)) for k in range(0, n, STRETCH))
    f[19] = packed / n
    f[20] = packed / (n + 60)
    f[21] = (size <= 3).mean()
    f[22] = len(set(zip(words, words[1:], words[2:]))) / max(1, count - 2)
    f[23] = sum(map(bytes.isupper, words)) / count
    f[24] = sum(map(bytes.istitle, words)) / count
    f[25] = np.log1p(size.max())
    return f


def expanded(x: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - centre) / spread, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z * z / 4, np.maximum(0, z - 1), np.maximum(0, -z - 1)], axis=1)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, steps: int = 1500, penalty: float = 1e-4) -> tuple:
    """Centre, spread and weights that minimise the non-negative risk."""
    every = np.concatenate([positive, unlabelled])
    centre = np.median(every, axis=0)
    spread = np.maximum(np.quantile(every, 0.84, axis=0) - np.quantile(every, 0.16, axis=0), 1e-3)
    p, u = expanded(positive, centre, spread), expanded(unlabelled, centre, spread)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        as_positive = -prior * ((1 - sp)[:, None] * p).mean(0)
        as_negative = (su[:, None] * u).mean(0) - prior * (sp[:, None] * p).mean(0)
        risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        g = (as_positive + as_negative if risk >= 0 else -as_negative) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.03 * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return centre, spread, w


def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"statistics": [statistics(t).tobytes() for t in batch["text"]]})


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE) -> tuple:
    """labels: the rows that may be learned from. Returns (centre, spread, weights) or, without positives, a constant score."""
    common.bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double")).alias("prior")).first()
    prior = float(known.prior or 0.0)
    chosen = sample_rows(docs, labels.filter(F.col(label) == 1), label, sample).select("text")
    web = docs.select("doc_id", "text").join(F.broadcast(docs.select("doc_id").filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id", F.lit("web")), "doc_id").limit(sample)), "doc_id", "left_semi").select("text")
    read = lambda df: np.array([np.frombuffer(r.statistics) for r in df.mapInPandas(measured, "statistics binary").collect()]).reshape(-1, FEATURES)
    positive, unlabelled = read(chosen), read(web)
    if not len(positive) or not len(unlabelled):
        return (prior,)
    return fit(positive, unlabelled, prior)


def scored(docs: DataFrame, model: tuple, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a score column."""
    common.bounded_batches(docs.sparkSession)

    def score(texts: pd.Series) -> pd.Series:
        if len(model) == 1:
            return pd.Series(np.full(len(texts), model[0]))
        centre, spread, w = model
        x = np.array([statistics(t) for t in texts]).reshape(-1, FEATURES)
        return pd.Series(1 / (1 + np.exp(-np.clip(expanded(x, centre, spread) @ w, -40, 40))))

    return docs.withColumn(score_col, F.pandas_udf(score, "double")(text_col))


def learned(docs: DataFrame, labels: DataFrame) -> tuple:
    return train(docs, labels.filter(fold("doc_id", 5) != 0))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.documents(spark, sf_dir), common.labels(spark, sf_dir)
    out = scored(docs.select("doc_id", "text"), learned(docs, labels))
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
