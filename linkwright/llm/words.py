"""Vectorised word fingerprints over Arrow string batches.

A batch of texts is one UTF-8 buffer.  Words are found with a byte-class table,
and each gets a 64-bit fingerprint from prefix sums of a polynomial with an odd
base modulo 2**64, so nothing in here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: Bytes handled at once; a longer text is handled alone, whole.
CHUNK_BYTES = 1 << 21

#: Words are runs of bytes that are not space, tab, LF, VT, FF or CR.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of ASCII letters and digits and of all bytes above ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each, kept per process."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 2)
        _POWERS[:] = [powers_of(b, size) for b in (_BASE, _INV)]
    return _POWERS[0], _POWERS[1]


def powers_of(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.cumprod(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all bits of a sum or product are good."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """The words of some texts: word i of text t is at position first[t] + i."""

    data: np.ndarray  # bytes of these texts, lower-cased if asked for
    begin: np.ndarray  # byte offset of each word in data
    end: np.ndarray
    hash: np.ndarray  # uint64 fingerprint of each word
    first: np.ndarray  # len(texts) + 1 offsets into the words
    rows: range  # the rows of the batch

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word, counted from 0."""
        return np.repeat(np.arange(len(self.rows)), self.counts())

    def text(self, i: int, j: int) -> bytes:
        return self.data[self.begin[i] : self.end[j - 1]].tobytes()


def words_of(data: np.ndarray, bounds: np.ndarray, rows: range, table: np.ndarray, lower: bool) -> Words:
    """Words of the texts whose bytes are data[bounds[t]:bounds[t + 1]]."""
    if lower:
        data = _LOWER[data]
    inside = table[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[cut]  # a text's first byte begins a word even if the text before ends in one
    ends[cut - 1] = inside[cut - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:])
    h = (total[end] - total[begin]) * down[begin]
    h = mix(h + (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))
    return Words(data, begin, end, h, np.searchsorted(begin, bounds), rows)


def chunks(column: pa.Array, table: np.ndarray, lower: bool) -> Iterator[Words]:
    """Words of a string column, some texts at a time; null texts have none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        to = min(to, n)
        yield words_of(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], range(at, to), table, lower)
        at = to


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of width words, by position of its first word.

    Runs that cross from one text to the next are computed too; see inside().
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    c = U64(0xA0761D6478BD642F)
    if width <= 16:
        for i in range(width):
            out *= c
            out += h[i : i + n]
    else:
        up, down = powers_of(int(c), len(h) + 1), powers_of(pow(int(c), -1, 1 << 64), len(h) + 1)
        total = np.zeros(len(h) + 1, dtype=U64)
        np.cumsum(h * up[: len(h)], out=total[1:])
        out = (total[width:] - total[:-width]) * down[:n]
    return mix(out + U64(width))


def starts_inside(w: Words, width: int) -> np.ndarray:
    """For each word position of rolling(w.hash, width): does the run stay in one text?"""
    n = len(w.hash) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    own = w.owner()
    return own[:n] == own[width - 1 :]


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of width entries, by doubling."""
    have, out = 1, a
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    if have < width:
        step = width - have
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
    return out
