"""Vectorised words, lines and span hashes over Arrow text columns.

A batch of texts is one UTF-8 byte buffer with document offsets, so words
(maximal runs without ASCII white space, ``[^\\x20\\x09-\\x0D]+``), lines and
their 64-bit hashes come from numpy passes over bytes, with no Python work
per word. A span's hash is a random-table polynomial hash modulo 2^64 followed
by a 64-bit finaliser; unequal spans collide with probability about 2^-64.

Long texts: the prefix hash is built segment by segment (``SEGMENT`` bytes),
so temporary memory is a small multiple of the segment, plus one byte per
text byte, whatever the length of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
SEGMENT = 1 << 18
SLICE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# one random 64-bit value per byte; the second table folds A-Z onto a-z
EXACT = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED = EXACT.copy()
FOLDED[0x41:0x5B] = EXACT[0x61:0x7B]

_tables: dict[int, np.ndarray] = {}


def _powers(base: int) -> np.ndarray:
    if base not in _tables:
        t = np.full(SEGMENT + 1, base, dtype=np.uint64)
        t[0] = 1
        _tables[base] = np.cumprod(t, dtype=np.uint64)
    return _tables[base]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hash of each byte span ``[start, end)``; starts and ends ascend."""
    up, down = _powers(_BASE), _powers(_BASE_INVERSE)
    at_start = np.zeros(len(starts), dtype=np.uint64)
    at_end = np.zeros(len(ends), dtype=np.uint64)
    unshift = np.zeros(len(starts), dtype=np.uint64)
    carry, scale, unscale = 0, 1, 1
    step, unstep = pow(_BASE, SEGMENT, 1 << 64), pow(_BASE_INVERSE, SEGMENT, 1 << 64)
    for s in range(0, len(buf), SEGMENT):
        e = min(s + SEGMENT, len(buf))
        prefix = np.zeros(e - s + 1, dtype=np.uint64)
        np.cumsum(table[buf[s:e]] * up[: e - s], dtype=np.uint64, out=prefix[1:])
        prefix *= np.array(scale, dtype=np.uint64)
        prefix += np.array(carry, dtype=np.uint64)
        a, b = np.searchsorted(starts, [s, e])
        at_start[a:b] = prefix[starts[a:b] - s]
        unshift[a:b] = down[starts[a:b] - s] * np.array(unscale, dtype=np.uint64)
        a, b = np.searchsorted(ends, [s + 1, e + 1])
        at_end[a:b] = prefix[ends[a:b] - s]
        carry = int(prefix[-1])
        scale, unscale = scale * step & MASK, unscale * unstep & MASK
    length = (ends - starts).astype(np.uint64)
    return mix64((at_end - at_start) * unshift + length * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Texts:
    """One slice of a text column: bytes, and where each document starts."""

    buf: np.ndarray
    offsets: np.ndarray
    first: int
    rows: int

    def count(self, hits: np.ndarray) -> np.ndarray:
        """Per document, how many of the ascending byte positions it holds."""
        return np.diff(np.searchsorted(hits, self.offsets))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, index of each document's first word, n + 1 long)."""
        return self._runs(~SPACE[self.buf])

    def _runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(inside)
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        before = np.ones(n, dtype=bool)
        before[1:] = ~inside[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = ~inside[1:]
        starts = np.flatnonzero(inside & (before | cut[:n]))
        ends = np.flatnonzero(inside & (after | cut[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Non-empty ``\\n``-split lines as (starts, ends, first line of each document)."""
        return self._runs(self.buf != 0x0A)


def slices(column: pa.Array) -> Iterator[Texts]:
    """A text column (null: empty) in slices of about ``SLICE_BYTES``; a longer text is a slice of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, side="right")) - 1)
        b = min(b, len(column))
        part = offsets[a : b + 1]
        yield Texts(raw[part[0] : part[-1]], part - part[0], a, b - a)
        a = b


def owners(firsts: np.ndarray) -> np.ndarray:
    """Document index of every word (or line) from the first-index array."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def windows(hashes: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows that stay in one document.

    Returns (window hash, position of its first word, owning document)."""
    n = len(hashes)
    if n < k:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), none, none
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        total = mix64(total + hashes[i : n - k + 1 + i] * np.uint64(2 * i + 3))
    owner = owners(firsts)
    keep = np.flatnonzero(owner[: n - k + 1] == owner[k - 1 :])
    return total[keep], keep, owner[keep]


def repeated(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags over (owner, value) pairs: (occurs twice or more, equals an earlier one)."""
    key = mix64(values ^ mix64(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), dtype=bool)
    same[1:] = key[order][1:] == key[order][:-1]
    twice = same.copy()
    twice[:-1] |= same[1:]
    out_twice, out_again = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    out_twice[order], out_again[order] = twice, same
    return out_twice, out_again
