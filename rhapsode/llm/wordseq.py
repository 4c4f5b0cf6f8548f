"""Words of texts and their hashes in arrays: n-grams and sliding minima."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

#: Bytes whose words are hashed at a time, cut at white space; working memory is about 30 times that.
PIECE = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        x = np.full(n, b, dtype=np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(256, dtype=np.uint64), 77)


def words_in(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, hash) of each word, a run without ASCII white space.

    A word's hash is a polynomial of its bytes, taken from prefix sums over a piece of the text, then mixed.
    """
    starts, ends, hashes, at = [], [], [], 0
    value = _byte_values()
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw):
            m = _SPACE.search(raw, end)
            end = m.start() if m else len(raw)
        c = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        space = np.ones(len(c) + 2, dtype=bool)
        space[1:-1] = (c == 32) | (c - np.uint8(9) < 5)
        edges = np.flatnonzero(space[1:] != space[:-1])
        a, b = edges[::2], edges[1::2]
        up, down = _powers(1 << max(PIECE + 4096, len(c) + 1).bit_length())
        sums = np.zeros(len(c) + 1, dtype=np.uint64)
        np.cumsum(value.take(c) * up[: len(c)], out=sums[1:])
        starts.append(a + at), ends.append(b + at), hashes.append(mixed((sums[b] - sums[a]) * down[a]))
        at = end
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)) if starts else (none, none, none.astype(np.uint64))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return words_in(b" ".join(words))[2]


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of word hashes; a shorter sequence is one gram."""
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1 if n else 0, dtype=np.uint64)
    for k in range(n):
        out = mixed(out + h[k : k + len(out)], k)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = x, 1
    while have < width:
        go = min(have, width - have)
        out = np.minimum(out[: len(out) - go], out[go:])
        have += go
    return out


def minimizers(g: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least value of each run of ``width`` values, the first one where several are least."""
    if not len(g):
        return np.zeros(0, dtype=np.int64)
    low = np.uint64((1 << 32) - 1)  # positions; a text has fewer than 2^32 words
    m = sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), min(width, len(g)))
    return np.unique(m & low).astype(np.int64)
