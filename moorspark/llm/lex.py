"""Byte-level lexing of Arrow text batches in numpy: blocks, words, hashes, sums per document.

A block is a run of whole documents of one Arrow batch with at most ``BLOCK`` bytes of text; a longer document is a
block of its own, so memory follows the longest document and never the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_G = np.random.default_rng(20240607)
_R = _G.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = [0x20, *range(0x09, 0x0E)]


def byte_class(pairs: Iterable[tuple[int, int]]) -> np.ndarray:
    """True for the bytes in the closed ranges ``pairs``."""
    t = np.zeros(256, bool)
    for a, b in pairs:
        t[a : b + 1] = True
    return t


#: letters, digits and every byte of a character outside ASCII; the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
ALNUM = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: everything but ASCII blanks; the words ``[^\x20\x09-\x0D]+``
BLACK = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into ``(rows, bytes, offsets)`` of whole documents."""
    buf, off = text_buffers(batch.column(text))
    n, a = batch.num_rows, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield batch.slice(a, b - a), buf[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


class Words:
    """Word spans of a block: byte ``start``/``end``, ``ptr[d]:ptr[d+1]`` are the words of document ``d``."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, table: np.ndarray):
        n = len(buf)
        m = np.zeros(n + 2, bool)
        m[1:-1] = table[buf]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        self.start = np.flatnonzero(m[1:-1] & (~m[:-2] | edge[:-1]))
        self.end = np.flatnonzero(m[1:-1] & (~m[2:] | edge[1:])) + 1
        self.ptr = np.searchsorted(self.start, off)
        self.counts = np.diff(self.ptr)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n; kept up to twice the block size."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size = 1 << max(16, (n - 1).bit_length())
    out = []
    with np.errstate(over="ignore"):
        for base in (_P, _PINV):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    if size <= 4 * BLOCK:
        _powers[:] = out
    return out[0][:n], out[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Sums:
    """Hash of any span of a sequence of 64-bit values from prefix sums, independent of where the span stands."""

    def __init__(self, values: np.ndarray):
        p, self.inv = powers(len(values) + 1)
        self.h = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * p[:-1], out=self.h[1:])

    def every(self, size: int) -> np.ndarray:
        """Hashes of all spans of one size, as :meth:`span` gives them, in few temporaries."""
        x = self.h[size:] - self.h[:-size]
        x *= self.inv[: len(x)]
        x += np.uint64(size * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)
        return mix(x)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.h[end] - self.h[start]) * self.inv[start] + (end - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def byte_sums(buf: np.ndarray, lower: bool) -> Sums:
    return Sums((_R[_LOWER] if lower else _R)[buf])


def word_hash(word: str | bytes) -> int:
    """Hash of one lower-cased word, equal to ``byte_sums(..., True).span`` over it."""
    b = np.frombuffer(word.encode() if isinstance(word, str) else word, np.uint8)
    return int(byte_sums(b, True).span(np.array([0]), np.array([len(b)]))[0])


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def per_doc(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``ptr``."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[ptr[1:]] - c[ptr[:-1]]


def cover(start: np.ndarray, length: int, size: int) -> np.ndarray:
    """True where any span ``[start, start + length)`` lies."""
    d = np.zeros(size + 1, np.int32)
    np.add.at(d, start, 1) if len(start) < 64 else d.__iadd__(np.bincount(start, minlength=size + 1).astype(np.int32))
    e = np.bincount(np.minimum(start + length, size), minlength=size + 1).astype(np.int32)
    return np.cumsum(d - e)[:size] > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of True."""
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)
