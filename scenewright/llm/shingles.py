"""Word shingles as 64-bit numbers, from whole texts (helper of the near-duplicate operator)."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240601))
#: A random number for each byte; A-Z share those of a-z.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
BYTE[65:91] = BYTE[97:123]
#: Words are separated by bytes 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15 | 1
PLACES = _rng.integers(1, 1 << 63, 8, dtype=U64) * U64(2) + U64(1)
#: Bytes hashed at once, save where one word is longer.
BLOCK = 1 << 20
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        n = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(n, b, U64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _powers[:] = made
    return _powers[0], _powers[1]


def word_hashes(raw: bytes) -> np.ndarray:
    data, found, at = np.frombuffer(raw, np.uint8), [], 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        part = data[at:end]
        at = end
        gap = SPACE[part]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        if not len(edge):
            continue
        power, inverse = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(BYTE[part] * power[: len(part)], out=total[1:])
        start, stop = edge[::2], edge[1::2]
        found.append(mixed((total[stop] - total[start]) * inverse[start]))
    return np.concatenate(found) if found else np.zeros(0, U64)


def shingle_set(text: str | None, words: int = 4) -> np.ndarray:
    """Sorted distinct shingles of so many words; the whole sequence where there are fewer; empty without words."""
    w = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(w):
        return w
    size = min(words, len(w))
    total = np.full(len(w) - size + 1, size, U64)
    for k in range(size):
        total += mixed(w[k : len(w) - size + 1 + k] * PLACES[k] + U64(k + 1))
    return np.unique(mixed(total))
