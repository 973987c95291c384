"""SentencePiece encoding and decoding as a max-plus parallel scan (operator 8).

A text is cut into the vocabulary's pieces so that the sum of their scores is largest
(Viterbi; characters outside the vocabulary become byte pieces). The vocabulary file lists
its pieces by rank, not by probability; tokenizers are not trained here, so a piece's score
is Zipf's law for its rank, -log(1 + rank), in whole units of 1 / `UNITS`, whose sums are
exact in any order. Ids are therefore those of the best-scoring path, not of byte-pair merges.

Best paths must break where no piece crosses: before a space that follows another character,
and around characters that no longer piece holds. Words between such breaks are solved many
at a time, by the tokenizer library's search over the same scores, and remembered. A giant text is split into chunks of `CHUNK` characters wherever they fall;
the state at a cut is how many characters of the piece across it lie before the cut. Each
chunk yields, on its own, the matrix of best scores from every state at its start to every
state at its end. The matrices are combined associatively by max-plus products, first in
blocks of `SPAN` chunks and then over the blocks, which gives the best score of each state at
each cut. From these each chunk tells which state at its start belongs to each state at its end;
such maps are combined from the right, and each chunk then traces back between its two states.
So equal sums, of which there are many, are decided in chunks as they are in whole texts.

Defined results: null and empty texts have no ids; equal sums go to the path whose last
pieces start first, as in the common implementation; a literal U+2581 decodes to a space;
repeated rows and null ids are rows like others; empty tables give no rows; of the input's
columns only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .memo import worker_memory

SPACE = "▁"
CHUNK = 1 << 15
WORDS_KEPT = 350_000
#: Rows whose words are looked up together, and words that are solved together.
ROWS, TOGETHER = 100, 5000
NOT_KNOWN = 0xFFFFFFFF
NOWHERE = float("-inf")
UNITS = 1 << 16
#: Chunks whose matrices are combined together.
SPAN = 256
#: A space that follows neither a space nor a line end.
WORD = re.compile(f"[^{SPACE}\n]{SPACE}")


class Pieces:
    """Vocabulary with scores, and the best path of any stretch of normalised text."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        memory = worker_memory(f"pieces of {path}")
        if "made" not in memory:
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            every = range(sp.get_piece_size())
            bytes_at = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
            usual = [i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
            known = {sp.id_to_piece(i): (i, -float(round(UNITS * math.log1p(rank)))) for rank, i in enumerate(sorted(usual, key=lambda i: (-sp.get_score(i), i)))}
            text_of = {i: p for p, (i, _) in known.items()}
            joined = {c for p in known if len(p) > 1 for c in p}
            inside = {(a, b) for p in known for a, b in zip(p, p[1:], strict=False)}
            assert not any(a != SPACE and b == SPACE for a, b in inside), "pieces cross word starts"
            table: dict[str, tuple[int, float]] = {p[:k]: (-1, 0.0) for p in known for k in range(1, len(p))} | known  # beginnings of pieces have id -1
            shown = [text_of.get(i, chr(i - bytes_at[0]) if bytes_at[0] <= i < bytes_at[128] else "") for i in every]
            unknown = min(s for _, s in known.values()) - 10
            score_of = np.zeros(len(every))
            for i, score in known.values():
                score_of[i] = score
            for b, i in bytes_at.items():
                score_of[i] = 0.0 if b & 0xC0 == 0x80 else unknown  # a character counts once, at its first byte
            from tokenizers import Tokenizer
            from tokenizers.models import Unigram

            # the same scores for the library's search over many words; its first entry stands for characters that no piece has
            names = sorted(known, key=lambda p: known[p][0])
            memory["fast"] = Tokenizer(Unigram([("\ufffe", unknown + 10), *[(p, known[p][1]) for p in names]], unk_id=0, byte_fallback=False))
            memory["back"] = np.array([NOT_KNOWN, *[known[p][0] for p in names]], "<u4")
            memory["mark"] = next(p for p in names if len(p) == 1 and p not in joined and p != SPACE and p > "\u3000")
            memory["made"] = known, table, shown, bytes_at, {i: b for b, i in bytes_at.items()}, text_of, joined, max(map(len, known)), unknown, score_of
        self.known, self.table, self.shown, self.bytes_at, self.byte_of, self.text_of, self.joined, self.longest, self.unknown, self.score_of = memory["made"]
        self.fast, self.back, self.mark = memory["fast"], memory["back"], memory["mark"]
        self.mark_id = self.known[self.mark][0]
        self.starts: dict[str, bytes] = memory.setdefault("after a space", {})
        self.bare: dict[str, bytes] = memory.setdefault("bare", {})

    def forward(self, s: str, best: list[float], via: list[tuple | None], begin: int, least_end: int = 0) -> None:
        """Relax all pieces from begin on; the pieces that start at begin end at least_end or later."""
        table, n = self.table, len(s)
        for i in range(begin, n):
            now = best[i]
            if now == NOWHERE:
                continue
            single, first = False, i == begin
            for j in range(i + 1, n + 1):
                if (found := table.get(s[i:j])) is None:
                    break
                piece, score = found
                if piece >= 0:
                    if j == i + 1:
                        single = True
                    if now + score > best[j] and not (first and j < least_end):
                        best[j], via[j] = now + score, (i, piece)
            if not single and now + self.unknown > best[i + 1] and not (first and i + 1 < least_end):
                best[i + 1], via[i + 1] = now + self.unknown, (i, -1)

    def between(self, s: str, begin: int, stop: int, least_end: int = 0) -> tuple[list[int], float]:
        """Ids and score of the best path over s[begin:stop]."""
        best, via = [NOWHERE] * (stop + 1), [None] * (stop + 1)
        best[begin] = 0.0
        self.forward(s[:stop], best, via, begin, least_end)
        ids, at = [], stop
        while at > begin:
            i, piece = via[at]
            ids += [piece] if piece >= 0 else [self.bytes_at[b] for b in reversed(s[i].encode("utf-8", "replace"))]
            at = i
        return ids[::-1], best[stop]

    def word(self, s: str) -> bytes:
        return np.array(self.between(s, 0, len(s))[0], "<u4").tobytes()

    def solve(self, parts: list[str]) -> list[bytes]:
        """Ids of normalised strings of which none depends on another, many at a time: the vocabulary's Viterbi search over them all, set apart by a character that breaks every path."""
        out: list[bytes] = []
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            ids = self.back[np.array(self.fast.encode(self.mark + self.mark.join(some), add_special_tokens=False).ids)]
            edge = np.flatnonzero(ids == self.mark_id)
            if len(edge) != len(some):  # one of them holds the mark itself
                out += map(self.word, some)
                continue
            raw = ids.tobytes()
            found = [raw[a + 4 : b] for a, b in zip((edge * 4).tolist(), [*(edge[1:] * 4).tolist(), len(raw)], strict=True)]
            for k in np.unique(np.searchsorted(edge, np.flatnonzero(ids == NOT_KNOWN)) - 1).tolist():
                found[k] = self.word(some[k])  # with byte pieces
            out += found
        return out

    def learn(self, memo: dict[str, bytes], words: set[str], before: str) -> None:
        """Put the ids of all of words, each with `before` in front, into the memory."""
        new = words.difference(memo)
        if len(memo) + len(new) > WORDS_KEPT:
            memo.clear()
            new = words
        new = list(new)
        memo.update(zip(new, self.solve([before + w for w in new]), strict=True))

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, as little-endian 32-bit numbers."""
        out, plain, after, first = [b""] * len(texts), [], set(), set()
        for k, text in enumerate(texts):
            if not text:
                continue
            if "\n" in self.joined or text[0] == " " or "  " in text or SPACE in text or "\n " in text or " \n" in text:
                out[k] = self.spelled(SPACE + text.replace(" ", SPACE))
                continue
            lines = [line.split(" ") for line in text.split("\n")]
            plain.append((k, lines))
            after.update(lines[0])
            for words in lines[1:]:
                first.add(words[0])
                after.update(words[1:])
        self.learn(self.starts, after, SPACE)
        self.learn(self.bare, first, "")
        starts, bare, newline = self.starts, self.bare, self.word("\n") if len(first) else b""
        for k, lines in plain:
            ids = list(map(starts.__getitem__, lines[0]))
            for words in lines[1:]:
                ids += [newline, bare[words[0]], *map(starts.__getitem__, words[1:])]
            out[k] = b"".join(ids)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def spelled(self, s: str) -> bytes:
        """Ids of normalised text, stretch by stretch."""
        parts = self.stretches(s)
        self.learn(self.bare, set(parts), "")
        return b"".join(map(self.bare.__getitem__, parts))

    def stretches(self, s: str) -> list[str]:
        """Parts between places that every best path breaks at."""
        if "\n" in self.joined:
            return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", s)
        return re.findall(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", s)

    def middle(self, s: str, begin: int) -> tuple[int, int]:
        """The first and last place from begin on at which a word starts after a space, so that every best path breaks there; twice len(s) if there is none."""
        first = last = len(s)
        if found := WORD.search(s, begin):
            first = last = found.start() + 1
            tail = s.rfind(SPACE, first)
            while tail > first and s[tail - 1] in (SPACE, "\n"):
                tail = s.rfind(SPACE, first, tail)
            last = max(first, tail)
        return first, last

    def inner(self, s: str) -> bytes:
        """Ids of normalised text that begins with a space and ends at a break."""
        return self.encode(s[1:].replace(SPACE, " ")) if len(s) > 1 else b""

    def transfer(self, before: str, s: str) -> np.ndarray:
        """Best scores from each state at the start of s to each at its end; before holds the characters left of it."""
        k_in, whole = len(before), before + s
        states = self.longest
        out = np.full((states, states), NOWHERE)
        head, last = self.middle(whole, k_in)
        rest = None
        if head < len(whole):
            best, via = [NOWHERE] * (len(whole) - last + 1), [None] * (len(whole) - last + 1)
            best[0] = float(self.score_of[np.frombuffer(self.inner(whole[head:last]), "<u4")].sum())
            self.forward(whole[last:], best, via, 0)
            rest = np.array([best[-1 - k] if k < len(best) else NOWHERE for k in range(states)])
        for k in range(min(states, k_in + 1)):
            begin = k_in - k
            best, via = [NOWHERE] * (head + 1), [None] * (head + 1)
            best[begin] = 0.0
            self.forward(whole[:head], best, via, begin, k_in + 1 if k else 0)
            if rest is not None:
                out[k] = best[head] + rest
            else:
                ends = [best[head - j] if head - j > k_in or (head - j == k_in and k == 0) else NOWHERE for j in range(min(states, head))]
                out[k, : len(ends)] = ends
        return out

    def entered(self, before: str, part: str, scores: np.ndarray) -> np.ndarray:
        """For each state at the end the state at the start that the chosen path has, given the best score of each state at the start.

        The scores are those of the best paths up to the places before the cut, so going on
        from them all finds the places' scores as in the whole text, and of equal sums the one
        whose last pieces start first, too.
        """
        s, cut = before + part, len(before)
        head, _ = self.middle(s, cut)
        best, origin = [NOWHERE] * (head + 1), [0] * (head + 1)
        for k in range(min(len(scores), cut + 1)):
            best[cut - k], origin[cut - k] = float(scores[k]), k
        for i in range(max(0, cut + 1 - len(scores)), head):
            now, single = best[i], False
            if now == NOWHERE:
                continue
            for j in range(i + 1, head + 1):
                if (found := self.table.get(s[i:j])) is None:
                    break
                single |= j == i + 1 and found[0] >= 0
                if j > cut and found[0] >= 0 and now + found[1] > best[j]:
                    best[j], origin[j] = now + found[1], origin[i]
            if not single and i + 1 > cut and now + self.unknown > best[i + 1]:
                best[i + 1], origin[i + 1] = now + self.unknown, origin[i]
        if head < len(s):  # every path breaks there
            return np.full(len(scores), origin[head], np.int16)
        return np.array([origin[head - k] if head - k > cut else k - len(part) if k >= len(part) else 0 for k in range(len(scores))], np.int16)

    def traced(self, before: str, part: str, enter: int, leave: int) -> bytes:
        """Ids of the chunk's best path from one state to another; a piece belongs to the chunk that it ends in."""
        s, begin = before + part, len(before) - enter
        stop = len(s) - leave
        least = len(before) + 1 if enter else 0
        head, last = self.middle(s[:stop], len(before))
        out = np.array(self.between(s, begin, head, least)[0], "<u4").tobytes()
        if head < stop:
            out += self.inner(s[head:last]) + np.array(self.between(s[last:stop], 0, stop - last)[0], "<u4").tobytes()
        return out

    def decode(self, ids: np.ndarray) -> str:
        if not ((ids >= self.bytes_at[128]) & (ids <= self.bytes_at[255])).any():
            return "".join(map(self.shown.__getitem__, ids.tolist())).replace(SPACE, " ")[1:]
        out, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(self.text_of[i])
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")[1:]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of two stacks of matrices."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(axis=-2)


def scanned(m: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices: an associative scan in log2(n) rounds of independent products."""
    if len(m) == 1:
        return m
    pairs = scanned(product(m[: len(m) // 2 * 2 : 2], m[1::2]))
    out = np.empty_like(m)
    out[0], out[1::2] = m[0], pairs
    later = (len(m) - 1) // 2
    out[2::2] = product(pairs[:later], m[2::2])
    return out


def matrices(frame: pd.DataFrame) -> np.ndarray:
    size = int(np.sqrt(len(frame["matrix"].iloc[0]) / 8))
    return np.array([np.frombuffer(x).reshape(size, size) for x in frame["matrix"]])


def block_product(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("chunk")
    return pd.DataFrame({"key": frame["key"].iloc[:1], "block": frame["block"].iloc[:1], "matrix": [scanned(matrices(frame))[-1].tobytes()]})


def scores_at_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """The best score of each state at the start of each block of a text."""
    frame = frame.sort_values("block")
    m = matrices(frame)
    start = np.full(m.shape[1], NOWHERE)
    start[0] = 0.0
    ahead = [start, *scanned(m)[:-1, 0, :]]
    return frame[["key", "block"]].assign(scores=[v.tobytes() for v in ahead])


def scores_at_chunks(frame: pd.DataFrame) -> pd.DataFrame:
    """The same at the start of each chunk of a block."""
    frame = frame.sort_values("chunk")
    start = np.frombuffer(frame["scores"].iloc[0])
    ahead = [start, *(start[:, None] + scanned(matrices(frame))[:-1]).max(axis=1)]
    return frame[["key", "block", "chunk"]].assign(scores=[v.tobytes() for v in ahead])


def turned_back(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16) for x in frame["back"]]


def block_back(frame: pd.DataFrame) -> pd.DataFrame:
    """For each state at the end of a block the state at its start: its chunks' maps, one after the other from the right."""
    whole = None
    for back in reversed(turned_back(frame.sort_values("chunk"))):
        whole = back if whole is None else back[whole]
    return pd.DataFrame({"key": frame["key"].iloc[:1], "block": frame["block"].iloc[:1], "back": [whole.tobytes()]})


def states_from_the_right(maps: list[np.ndarray], leave: int) -> tuple[list[int], list[int]]:
    enters, leaves = [], []
    for back in reversed(maps):
        leaves.append(leave)
        leave = int(back[leave])
        enters.append(leave)
    return enters[::-1], leaves[::-1]


def states_of_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("block")
    return frame[["key", "block"]].assign(leave=states_from_the_right(turned_back(frame), 0)[1])


def states_of_chunks(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("chunk")
    enter, leave = states_from_the_right(turned_back(frame), int(frame["leave"].iloc[0]))
    return frame[["key", "chunk"]].assign(enter=enter, leave=leave)


def digested(pieces: Pieces, ids: list[bytes]) -> pd.DataFrame:
    """n_tokens, ids_crc32 and decoded_sha256 of each."""
    decoded = [hashlib.sha256(pieces.decode(np.frombuffer(x, "<u4")).encode()).hexdigest() for x in ids]
    return pd.DataFrame({"n_tokens": [len(x) // 4 for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids], "decoded_sha256": decoded})


def encode(docs: DataFrame, *, model: str | None = None, chunk: int = CHUNK, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, and ids (binary, little-endian 32-bit numbers) of every row; with digests what `digested` makes of them in the same tasks."""
    spark = common.bounded_batches(docs.sparkSession)
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk
    made = "struct<n_tokens: bigint, ids_crc32: bigint, decoded_sha256: string>" if digests else "struct<ids: binary>"

    def finished(ids: list[bytes]) -> pd.DataFrame:
        return digested(Pieces(model), ids) if digests else pd.DataFrame({"ids": ids})

    def whole(column: pd.Series) -> pd.DataFrame:
        pieces, texts = Pieces(model), column.tolist()
        return finished([ids for at in range(0, len(texts), ROWS) for ids in pieces.encode_many(texts[at : at + ROWS])])

    def put_together(column: pd.Series) -> pd.DataFrame:
        return finished([b"".join(x) for x in column])

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = Pieces(model).longest - 1
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                s = SPACE + text.replace(" ", SPACE)
                for at in range(0, len(s), 64 * chunk):
                    cuts = range(at, min(len(s), at + 64 * chunk), chunk)
                    yield pd.DataFrame({"key": key, "chunk": [c // chunk for c in cuts], "before": [s[max(0, c - left) : c] for c in cuts], "part": [s[c : c + chunk] for c in cuts]})

    def transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model)
        for batch in batches:
            for at in range(0, len(batch), 16):
                some = batch.iloc[at : at + 16]
                yield some[["key", "chunk"]].assign(matrix=[pieces.transfer(b, p).tobytes() for b, p in zip(some["before"], some["part"], strict=True)])

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model)
        for batch in batches:
            yield batch[["key", "block", "chunk"]].assign(back=[pieces.entered(b, p, np.frombuffer(v)).tobytes() for b, p, v in zip(batch["before"], batch["part"], batch["scores"], strict=True)])

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(model)
        for batch in batches:
            for at in range(0, len(batch), 16):
                some = batch.iloc[at : at + 16]
                yield some[["key", "chunk"]].assign(ids=[pieces.traced(*x) for x in zip(some["before"], some["part"], some["enter"], some["leave"], strict=True)])

    large = texts.filter(giant).withColumn("key", common.text_key("text"))
    pieces_of = large.select("key", "text").mapInPandas(split, "key binary, chunk int, before string, part string")
    chunks = common.saved(pieces_of.groupBy("key", "chunk").agg(F.first(F.struct("before", "part")).alias("p")).select("key", "chunk", "p.*"), "piece-chunks")
    # a number given, so that these small rows with much work are not put into few tasks
    spread = chunks.repartition(parts, "key", "chunk")
    steps = common.saved(spread.mapInPandas(transfers, "key binary, chunk int, matrix binary").withColumn("block", F.floor(F.col("chunk") / span).cast("int")), "piece-matrices")
    blocks = steps.groupBy("key", "block").applyInPandas(block_product, "key binary, block int, matrix binary")
    starts = blocks.groupBy("key").applyInPandas(scores_at_blocks, "key binary, block int, scores binary")
    at_chunks = steps.join(starts, ["key", "block"]).groupBy("key", "block").applyInPandas(scores_at_chunks, "key binary, block int, chunk int, scores binary")
    known = chunks.join(at_chunks, ["key", "chunk"]).repartition(parts, F.xxhash64("key", "chunk"))
    backs = common.saved(known.mapInPandas(choose, "key binary, block int, chunk int, back binary"), "piece-states")
    ends = backs.groupBy("key", "block").applyInPandas(block_back, "key binary, block int, back binary").groupBy("key").applyInPandas(states_of_blocks, "key binary, block int, leave int")
    cuts = backs.join(ends, ["key", "block"]).groupBy("key", "block").applyInPandas(states_of_chunks, "key binary, chunk int, enter int, leave int")
    met = chunks.join(cuts, ["key", "chunk"]).repartition(parts, F.xxhash64("key", "chunk"))  # by other keys than the join's, else it is left out
    traced = met.mapInPandas(trace, "key binary, chunk int, ids binary")
    joined = traced.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"]).alias("parts"))
    joined = joined.select("key", F.pandas_udf(put_together, made)("parts").alias("m"))
    rows = large.select("doc_id", F.col("key").alias("k")).join(joined, F.col("k") == F.col("key")).select("doc_id", "m.*")
    return texts.filter(~giant).select("doc_id", F.pandas_udf(whole, made)("text").alias("m")).select("doc_id", "m.*").unionByName(rows)


def decode(ids: DataFrame, *, model: str | None = None) -> DataFrame:
    """The rows that encode() made, with text in place of ids."""

    def run(column: pd.Series) -> pd.Series:
        pieces = Pieces(model)
        return pd.Series([pieces.decode(np.frombuffer(x, "<u4")) for x in column], dtype=object)

    return ids.withColumn("text", F.pandas_udf(run, "string")("ids")).drop("ids")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, digest of the ids, and of the text that they decode to."""
    return encode(common.documents(spark, sf_dir), digests=True)
