"""Whole texts in bounded pieces of bytes, and streams of sorted rows in groups, for work inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts of a string column as bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def segments(raw: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Spans that cover raw, cut at white space, of about ``size`` bytes or the one word that is longer."""
    lo = 0
    while len(raw) - lo > size:
        m = _GAP.search(raw, lo + size)
        if m is None:
            break
        yield lo, m.start()
        lo = m.start()
    yield lo, len(raw)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by the key columns; only one group is held beside a batch."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        new = np.zeros(t.num_rows, dtype=bool)
        cols = [t.column(k).combine_chunks() for k in keys]
        for c in cols:
            a, b = c.slice(1), c.slice(0, len(c) - 1)
            new[1:] |= np.asarray(pc.fill_null(pc.not_equal(a, b), False)) | np.asarray(pc.xor(a.is_null(), b.is_null()))
        first = tuple(c[0].as_py() for c in cols)
        new[0] = last is not None and first != last
        at = 0
        for cut in np.flatnonzero(new):
            if cut > at:
                held.append(t.slice(at, cut - at))
            if held:
                yield pa.concat_tables(held)
            held, at = [], int(cut)
        held.append(t.slice(at))
        last = tuple(c[-1].as_py() for c in cols)
    if held:
        yield pa.concat_tables(held)


class Tally:
    """Counts of 64-bit keys in sorted arrays; full() beyond ``size`` different ones."""

    def __init__(self, size: int = 1 << 21):
        self.most = size
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        u, n = np.unique(keys, return_counts=True)
        self.held.append((u, n))
        self.size += len(u)
        if self.size > self.most and len(self.held) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held) > 1:
            k, n = (np.concatenate(x) for x in zip(*self.held, strict=True))
            by = np.argsort(k, kind="stable")
            k, n = k[by], n[by]
            at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            self.held = [(k[at], np.add.reduceat(n, at))]
            self.size = len(at)
        return self.held[0] if self.held else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))

    def full(self) -> bool:
        return self.size > self.most

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.held, self.size = [], 0
        return out
