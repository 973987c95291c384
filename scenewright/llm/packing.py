"""Packing documents into token windows by non-negative least squares (operator 9).

Each document is tokenised once, in Spark tasks. All its full windows are pieces of their
own; what is left of it has a length below the window, and only the histogram of those
lengths (at most window - 1 numbers) reaches the driver. There, shallow combinations of up
to three lengths that fill a window are enumerated, their repeat counts are solved for by
non-negative least squares against the histogram, rounded, and residual lengths are packed
greedily: whole where they fit within `slack` ids, else laid end to end and cut at window
ends. Spark ranks the documents of each length, in parts so that a frequent length is no
single group, and looks up where each rank goes.

Defined results: a null text is empty and gives one piece that holds the end id alone;
repeated rows and null ids are packed as rows of their own; an empty table gives no rows; of
the input's columns only the id and the text are read. Two tables are broadcast: the first
rank of each length and part (at most window * PARTS rows) and the plan (a row for each
length in each combination used: at most window + 3 for every combination).
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .memo import worker_memory

WINDOW = 2048
END_ID = 1
#: Ids left empty at most in a sequence that is packed whole.
SLACK = 12
#: Documents of one length are ranked in so many parts.
PARTS = 64
#: Words, and words without closing punctuation, whose ids a Python worker remembers at most.
WORDS_KEPT, STEMS_KEPT = 700_000, 500_000


class WordIds:
    """Ids of white-space-separated words, each as little-endian 32-bit numbers.

    A word of letters alone is one unit of the tokenizer, whose last id is a word end; such
    words are encoded many at a time, and closing punctuation apart from them. All others,
    and any batch whose word ends do not add up, are encoded word by word.
    """

    CLOSING = ".,;:!?$%&*#"

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        memory = worker_memory(f"word ids of {path}")
        if "model" not in memory:
            model = memory["model"] = Tokenizer.from_file(path)
            ends = memory["ends"] = np.zeros(model.get_vocab_size(), bool)
            for token, i in model.get_vocab().items():
                ends[i] = token.endswith("</w>")
        self.model, self.ends = memory["model"], memory["ends"]
        self.known: dict[bytes, bytes] = memory.setdefault("words", {})
        self.stems: dict[str, bytes] = memory.setdefault("stems", {})

    def one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(words, add_special_tokens=False)]

    def together(self, words: list[str]) -> list[bytes]:
        """words: of letters only."""
        ids = np.array(self.model.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        stop = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stop) != len(words) or not len(stop) or stop[-1] != 4 * len(ids):
            return self.one_by_one(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The memory, with all of words in it."""
        known, stems = self.known, self.stems
        new = words.difference(known)
        if len(known) + len(new) > WORDS_KEPT:
            known.clear()
            new = words
        if len(stems) + len(new) > STEMS_KEPT:
            stems.clear()
        plain, odd, missing, tails = [], [], set(), set()
        for w in new:
            text = w.decode("utf-8")
            stem = text.rstrip(self.CLOSING)
            if stem.isalpha():
                if stem.isascii():
                    stem = stem.lower()
                tail = text[len(stem) :]
                plain.append((w, stem, tail))
                if stem not in stems:
                    missing.add(stem)
                if tail and tail not in stems:
                    tails.add(tail)
            else:
                odd.append(w)
        wide = [x for x in missing if not x.isascii()]
        for k in range(0, len(wide), 10_000):
            stems.update(zip(wide[k : k + 10_000], self.together(wide[k : k + 10_000]), strict=True))
        bare, pack_ids = self.model.model.tokenize, struct.Struct
        for x in missing.difference(wide):  # lower-case ASCII letters need neither normalising nor splitting
            ids = [t.id for t in bare(x)]
            stems[x] = pack_ids(f"<{len(ids)}I").pack(*ids)
        tails = list(tails)
        stems.update(zip(tails, self.one_by_one(tails), strict=True))
        stems[""] = b""
        for w, stem, tail in plain:
            known[w] = stems[stem] + stems[tail]
        for k in range(0, len(odd), 10_000):
            part = odd[k : k + 10_000]
            known.update(zip(part, self.one_by_one([w.decode("utf-8") for w in part]), strict=True))
        return known


def tokenised(docs: DataFrame, *, tokenizer: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, doc_tokens, full_crcs (of each full window), rest (ids of what is left, as little-endian 32-bit numbers).

    The tokenizer drops white space and never looks across it, so the ids of a text are
    those of its ASCII-space-separated parts; parts seen before come from a bounded memory.
    """
    common.bounded_batches(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        ids_of = WordIds(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        known = ids_of.learn(set().union(*split))
        ids = [b"".join(map(known.__getitem__, words)) + end for words in split]
        size = [len(x) // 4 for x in ids]
        return pd.DataFrame({
            "doc_tokens": size,
            "full_crcs": [[zlib.crc32(x[4 * k : 4 * (k + window)]) for k in range(0, n - window + 1, window)] for x, n in zip(ids, size, strict=True)],
            "rest": [x[4 * (n // window * window) :] for x, n in zip(ids, size, strict=True)],
        })

    made = F.pandas_udf(run, "doc_tokens long, full_crcs array<long>, rest binary")
    return docs.select(F.col(id_col).alias("doc_id"), made(F.col(text_col)).alias("t")).select("doc_id", "t.*")


def combinations(h: np.ndarray, window: int, slack: int, thirds: int = 24) -> np.ndarray:
    """Rows of three lengths (0: none) whose sum is window, or short of it by slack at most; only lengths that occur."""
    have = np.flatnonzero(h)
    have = have[have > 0]
    if not len(have):
        return np.zeros((0, 3), np.int64)
    below = np.zeros(window + 1, np.int64)  # the largest length that occurs, up to each length
    below[have] = have
    below = np.maximum.accumulate(below)
    small = have[have <= window // 3]
    small = np.unique(small[np.linspace(0, len(small) - 1, min(thirds, len(small))).astype(int)]) if len(small) else small
    a, c = (x.ravel() for x in np.meshgrid(have, np.concatenate([[0], small]), indexing="ij"))
    room = window - a - c
    b = np.where(room > 0, below[np.clip(room, 0, window)], 0)
    rows = np.sort(np.stack([a, b, c], 1), axis=1)[:, ::-1]
    short = window - rows.sum(1)
    return np.unique(rows[(short >= 0) & (short <= slack)], axis=0)


def nnls(columns: np.ndarray, h: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that make the least squares of (uses of each length) - h, by accelerated projected gradients."""
    used = columns > 0

    def uses(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h))
        for k in range(columns.shape[1]):
            out += np.bincount(columns[:, k], weights=x * used[:, k], minlength=len(h))
        return out

    back = lambda r: (np.where(used, r[columns], 0.0)).sum(1)
    v = np.ones(len(columns))
    for _ in range(30):
        v = back(uses(v))
        v /= max(np.linalg.norm(v), 1e-12)
    bound = 1.05 * np.linalg.norm(back(uses(v))) + 1e-9
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - back(uses(y) - h) / bound)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def plan(h: np.ndarray, window: int = WINDOW, slack: int = SLACK) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """h[r]: documents of rest length r. Returns rows (r, first rank, end rank, sequence, offset, stream start) and the number of sequences.

    Rank k of a row goes to sequence + k - first, at offset; a stream row (sequence -1)
    lays its documents end to end from stream start on, in sequences counted from there.
    """
    left = h.astype(np.int64).copy()
    left[0] = 0
    whole: list[tuple[tuple[int, ...], int]] = []
    columns = combinations(left, window, slack)
    if len(columns):
        x = nnls(columns, left.astype(float))
        for i in np.argsort(-x, kind="stable"):
            if (n := int(np.floor(x[i] + 0.5))) <= 0:
                break
            parts = [int(p) for p in columns[i] if p]
            n = min(n, *(left[p] // parts.count(p) for p in parts))
            if n > 0:
                whole.append((tuple(parts), int(n)))
                np.subtract.at(left, parts, n)
    stream: list[tuple[int, int]] = []
    while left.any():  # the longest first, with the longest that still fit; each turn uses a length up or drops one
        top = int(np.flatnonzero(left)[-1])
        parts, room, spare = [top], window - top, left.copy()
        spare[top] -= 1
        while room > slack and len(fit := np.flatnonzero(spare[1 : room + 1])):
            p = int(fit[-1]) + 1
            parts.append(p)
            spare[p] -= 1
            room -= p
        if room <= slack:
            n = min(int(left[p]) // parts.count(p) for p in set(parts))
            whole.append((tuple(parts), n))
            np.subtract.at(left, parts, n)
        else:
            stream.append((top, int(left[top])))
            left[top] = 0
    rows, taken, sequence = [], np.zeros(len(h), np.int64), 0
    for parts, n in whole:
        offset = 0
        for p in parts:
            rows.append((p, int(taken[p]), int(taken[p]) + n, sequence, offset, 0))
            taken[p] += n
            offset += p
        sequence += n
    at = sequence * window
    for p, n in stream:
        rows.append((p, int(taken[p]), int(taken[p]) + n, -1, 0, at))
        at += p * n
    return rows, -(-at // window)


def pack(tokens: DataFrame, *, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = tokens.sparkSession
    base = common.saved(
        tokens.withColumn("r", (F.col("doc_tokens") % window).cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(PARTS)).cast("int")),
        "packing-tokens",
    )
    counted = base.groupBy("r", "part").agg(F.count(F.lit(1)).alias("n"), F.max("doc_tokens").alias("longest")).collect()  # at most window x PARTS rows
    h = np.zeros(window, np.int64)
    starts = []
    for row in sorted(counted, key=lambda x: (x.r, x.part)):
        starts.append((row.r, row.part, int(h[row.r])))
        h[row.r] += row.n
    many = max([0, *(row.longest for row in counted)]) // window
    rows, sequences = plan(h, window, slack)
    rows += [(0, 0, int(h[0]), -2, 0, 0)]
    ordinal = np.concatenate([[0], np.cumsum(h)])[:-1]
    first = spark.createDataFrame([(*s, int(ordinal[s[0]])) for s in starts], "r int, part int, first long, ordinal long")
    places = spark.createDataFrame([(r, lo, hi, s, o, at) for r, lo, hi, s, o, at in rows], "r int, lo long, hi long, sequence long, place long, stream long")
    ranked = (
        base.withColumn("n", F.row_number().over(Window.partitionBy("r", "part").orderBy("doc_id", "full_crcs", "rest")))
        .join(F.broadcast(first), ["r", "part"]).withColumn("rank", F.col("first") + F.col("n") - 1)
    )
    p = F.broadcast(places.withColumnRenamed("r", "r2"))
    placed = ranked.join(p, (F.col("r") == F.col("r2")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    full = F.transform("full_crcs", lambda crc, k: F.struct(
        (k * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), crc.alias("ids_crc32"),
        (F.lit(sequences) + (F.col("ordinal") + F.col("rank")) * many + k).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    ))
    begin = F.col("stream") + (F.col("rank") - F.col("lo")) * F.col("r")
    inside = F.when(F.col("sequence") == -1, begin % window).otherwise(F.col("place"))
    sequence = F.when(F.col("sequence") == -1, F.floor(begin / window)).otherwise(F.col("sequence") + F.col("rank") - F.col("lo"))
    head = F.least(F.col("r").cast("long"), window - inside)

    def piece(start, length, seq, offset):
        ids = F.substring("rest", (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct((F.col("doc_tokens") - F.col("r") + start).cast("long").alias("start"), length.cast("long").alias("length"), F.crc32(ids).alias("ids_crc32"), seq.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))

    some = F.when(F.col("r") > 0, F.array(piece(F.lit(0), head, sequence, inside))).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,ids_crc32:bigint,sequence_id:bigint,offset:bigint>>"))
    more = F.when(F.col("r") > head, F.array(piece(head, F.col("r") - head, sequence + 1, F.lit(0)))).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,ids_crc32:bigint,sequence_id:bigint,offset:bigint>>"))
    return placed.select("doc_id", "doc_tokens", F.explode(F.concat(full, some, more)).alias("p")).select(
        "doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset"
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(tokenised(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.documents(spark, sf_dir))
