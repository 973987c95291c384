"""ISO media containers as columns (operator 3).

`media_columns` walks the nested boxes of a container held in a binary column, decodes the
sample tables of its tracks and returns codec, time scale, duration, sample counts and the
byte ranges of the keyframes. It never decodes a payload; sample bytes are only located.
`text_to_media` makes such containers: a text becomes one track of 8-bit PCM samples.

Spark cuts the rows into tasks and streams Arrow batches through them; a task holds one
batch. Defined results: null bytes, bytes that are no container and truncated boxes give a
row with `error` set and nulls elsewhere; a null text is an empty one, stored as 64 zeros;
null ids and repeated rows are rows like any other; empty tables give no rows; of the input's
columns only the id and the bytes or text are read. Where a file has several tracks, the first
with samples is described; samples of fragments (`moof`) are not decoded, and `error` says so.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RATE = 8000
PACKET = 64
PACKETS_A_CHUNK = 64
#: Fixed values of ISO/IEC 14496-12: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}
UNITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, version: int, flags: int, *parts: bytes) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Unpadded length, and the UTF-8 bytes with zeros up to a positive multiple of 64."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def write_container(payload: bytes) -> bytes:
    """A file with one sound track of 8-bit mono PCM; each packet holds 64 samples, each chunk starts with a sync packet."""
    packets = len(payload) // PACKET
    chunks, last = -(-packets // PACKETS_A_CHUNK), packets % PACKETS_A_CHUNK
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 0), b"isom", b"mp42")
    mdat = box(b"mdat", payload)
    first = len(ftyp) + len(mdat) - len(payload)
    offsets = first + np.arange(chunks, dtype=np.uint64) * (PACKET * PACKETS_A_CHUNK)
    wide = len(ftyp) + len(mdat) >= 1 << 32
    runs = [(1, min(packets, PACKETS_A_CHUNK), 1)]
    if last and chunks > 1:
        runs.append((chunks, last, 1))
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
    stbl = box(
        b"stbl",
        full(b"stsd", 0, 0, struct.pack(">I", 1), entry),
        full(b"stts", 0, 0, struct.pack(">III", 1, packets, PACKET)),
        full(b"stss", 0, 0, struct.pack(">I", chunks), (1 + np.arange(chunks) * PACKETS_A_CHUNK).astype(">u4").tobytes()),
        full(b"stsc", 0, 0, struct.pack(">I", len(runs)), b"".join(struct.pack(">III", *r) for r in runs)),
        full(b"stsz", 0, 0, struct.pack(">II", PACKET, packets)),
        full(b"co64" if wide else b"stco", 0, 0, struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes()),
    )
    length = packets * PACKET
    minf = box(b"minf", full(b"smhd", 0, 0, bytes(4)), box(b"dinf", full(b"dref", 0, 0, struct.pack(">I", 1), full(b"url ", 0, 1))), stbl)
    mdia = box(
        b"mdia",
        full(b"mdhd", 1, 0, struct.pack(">QQIQHH", 0, 0, RATE, length, 0x55C4, 0)),
        full(b"hdlr", 0, 0, bytes(4), b"soun", bytes(12), b"sound\0"),
        minf,
    )
    tkhd = full(b"tkhd", 1, 7, struct.pack(">QQIIQ8xHHHH", 0, 0, 1, 0, length, 0, 0, 0x100, 0), UNITY, bytes(8))
    mvhd = full(b"mvhd", 1, 0, struct.pack(">QQIQIH10x", 0, 0, RATE, length, 0x10000, 0x100), UNITY, bytes(24), struct.pack(">I", 2))
    return ftyp + mdat + box(b"moov", mvhd, box(b"trak", tkhd, mdia))


def walk(data: memoryview, start: int, end: int, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of box types, body start, body end) of every box, outer ones first."""
    while start < end:
        if start + 8 > end:
            raise ValueError("box header cut off")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("long box header cut off")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind.decode('latin-1')} overruns")
        here = (*path, kind)
        yield here, start + head, start + size
        if kind in CONTAINERS:
            yield from walk(data, start + head, start + size, here)
        start += size


def numbers(data: memoryview, start: int, end: int, count: int, width: int, kind: str) -> np.ndarray:
    """count big-endian rows of width numbers that begin at start."""
    need = count * width * np.dtype(kind).itemsize
    if start + need > end:
        raise ValueError("sample table cut off")
    return np.frombuffer(data, dtype=kind, count=count * width, offset=start).astype(np.int64).reshape(count, width)


def read_tracks(data: bytes) -> list[dict]:
    """codec, handler, timescale, duration, and each sample's offset, size and sync mark, by track."""
    view, tracks, fragments = memoryview(data), [], False
    u32 = lambda at: struct.unpack_from(">I", view, at)[0]
    for path, a, b in walk(view, 0, len(view)):
        kind = path[-1]
        if kind == b"trak":
            tracks.append({})
        elif kind == b"moof":
            fragments = True
        elif not tracks or b"trak" not in path:
            continue
        t = tracks[-1]
        if kind == b"mdhd":
            t["timescale"], t["duration"] = struct.unpack_from(">IQ", view, a + 20) if view[a] == 1 else struct.unpack_from(">II", view, a + 12)
        elif kind == b"hdlr":
            t["handler"] = bytes(view[a + 8 : a + 12]).decode("latin-1")
        elif kind == b"stsd" and u32(a + 4):
            t["codec"] = bytes(view[a + 12 : a + 16]).decode("latin-1")
        elif kind == b"stts":
            t["times"] = numbers(view, a + 8, b, u32(a + 4), 2, ">u4")
        elif kind == b"stss":
            t["sync"] = numbers(view, a + 8, b, u32(a + 4), 1, ">u4")[:, 0]
        elif kind == b"stsc":
            t["runs"] = numbers(view, a + 8, b, u32(a + 4), 3, ">u4")
        elif kind == b"stsz":
            one, n = u32(a + 4), u32(a + 8)
            t["sizes"] = np.full(n, one, np.int64) if one else numbers(view, a + 12, b, n, 1, ">u4")[:, 0]
        elif kind == b"stz2":
            bits, n = view[a + 7], u32(a + 8)
            if bits == 4:
                pairs = numbers(view, a + 12, b, -(-n // 2), 1, "u1")[:, 0]
                t["sizes"] = np.stack([pairs >> 4, pairs & 15], 1).ravel()[:n]
            else:
                t["sizes"] = numbers(view, a + 12, b, n, 1, "u1" if bits == 8 else ">u2")[:, 0]
        elif kind in (b"stco", b"co64"):
            t["chunks"] = numbers(view, a + 8, b, u32(a + 4), 1, ">u4" if kind == b"stco" else ">u8")[:, 0]
    for t in tracks:
        t["error"] = "samples of fragments are not decoded" if fragments else None
        sizes, chunks, runs = t.get("sizes", np.zeros(0, np.int64)), t.get("chunks", np.zeros(0, np.int64)), t.get("runs", np.zeros((0, 3), np.int64))
        until = np.append(runs[1:, 0], len(chunks) + 1) if len(runs) else np.zeros(0, np.int64)
        held = np.repeat(runs[:, 1], np.maximum(0, until - runs[:, 0]))[: len(chunks)]
        if held.sum() < len(sizes):
            raise ValueError("chunks hold fewer samples than the size table")
        chunk_of = np.repeat(np.arange(len(held)), held)[: len(sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        first = np.concatenate([[0], np.cumsum(held)])[:-1].clip(max=max(0, len(sizes) - 1))
        t["offsets"] = chunks[chunk_of] + before - before[first[chunk_of]] if len(sizes) else np.zeros(0, np.int64)
        t["keys"] = t["sync"] - 1 if "sync" in t else np.arange(len(sizes))
        if len(t["keys"]) and (t["keys"].min() < 0 or t["keys"].max() >= len(sizes)):
            raise ValueError("sync table points outside")
    return tracks


def sample_bytes(data: bytes, track: dict) -> bytes:
    """The stored samples in order; neighbours are copied together."""
    at, size = track["offsets"], track["sizes"]
    if not len(at):
        return b""
    ends = at + size
    if ends.max() > len(data):
        raise ValueError("samples lie outside the file")
    cut = np.flatnonzero(at[1:] != ends[:-1]) + 1
    begin, stop = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
    return b"".join(data[at[i] : ends[j]] for i, j in zip(begin, stop, strict=True))


COLUMNS = "codec string, handler string, timescale long, duration long, n_samples long, n_keyframes long, keyframes array<struct<start: long, size: long>>, error string"


def describe(data: bytes | None) -> dict:
    """The columns of the first track that has samples."""
    out = dict.fromkeys(("codec", "handler", "timescale", "duration", "n_samples", "n_keyframes", "keyframes", "error"))
    try:
        tracks = read_tracks(data or b"")
        if not tracks:
            raise ValueError("no track")
        t = next((t for t in tracks if len(t["offsets"])), tracks[0])
    except (ValueError, struct.error) as e:
        return out | {"error": str(e), "track": None}
    at, size = t["offsets"][t["keys"]].tolist(), t["sizes"][t["keys"]].tolist()
    return out | {k: t.get(k) for k in ("codec", "handler", "timescale", "duration", "error")} | {"n_samples": len(t["offsets"]), "n_keyframes": len(at), "keyframes": [{"start": a, "size": s} for a, s in zip(at, size, strict=True)], "track": t}


def media_columns(media: DataFrame, *, id_col: str, bytes_col: str) -> DataFrame:
    """id, codec, handler, timescale, duration, n_samples, n_keyframes, keyframes, error for every row."""
    common.bounded_batches(media.sparkSession)
    names = [c.split()[0] for c in ("codec", "handler", "timescale", "duration", "n_samples", "n_keyframes", "keyframes", "error")]

    def run(data: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame([{k: v for k, v in describe(x).items() if k != "track"} for x in data], columns=names)
        for c in ("timescale", "duration", "n_samples", "n_keyframes"):
            rows[c] = rows[c].astype("Int64")
        return rows

    return media.select(F.col(id_col).alias("id"), F.pandas_udf(run, COLUMNS)(F.col(bytes_col)).alias("m")).select(F.col("id").alias(id_col), "m.*")


def text_to_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, media: every text stored as an ISO media file."""
    common.bounded_batches(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        made = [payload_of(t) for t in texts]
        return pd.DataFrame({"n_bytes": [n for n, _ in made], "media": [write_container(p) for _, p in made]})

    return docs.select(F.col(id_col), F.pandas_udf(run, "n_bytes long, media binary")(F.col(text_col)).alias("m")).select(id_col, "m.*")


DIGESTS = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration long, n_keyframes long"


def digests(data: pd.Series) -> pd.DataFrame:
    rows = []
    for media in data:
        media = bytes(media)
        d = describe(media)
        payload = sample_bytes(media, d["track"])
        keys = d["keyframes"]
        ranges = ",".join(f"{k['start']}+{k['size']}" for k in keys)
        feature = f"{d['codec']}|{d['handler']}|{d['duration']}/{d['timescale']}|{d['n_samples']}|{d['n_keyframes']}|{keys[0]['start']}-{keys[-1]['start'] + keys[-1]['size']}|{zlib.crc32(ranges.encode()):08x}"
        rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, d["codec"], d["duration"], d["n_keyframes"]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = text_to_media(common.documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text"))
    return stored.select("doc_id", "n_bytes", F.pandas_udf(digests, DIGESTS)("media").alias("d")).select("doc_id", "n_bytes", "d.*")
