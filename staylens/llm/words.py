"""Vectorised word scanning of Arrow text columns.

`text_buffer` exposes a column's UTF-8 bytes, `pieces` cuts it into runs of
whole rows of bounded size, `word_bounds` finds the words of every row and
`word_hashes` gives each word a 64-bit hash of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_PINV = pow(_P, -1, 1 << 64)
_SEGMENT = 1 << 18

#: Byte classes: text that is not white space, and letters, digits and non-ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_P))
_BYTES_LOWER = _BYTES[LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Table:
    """Powers of the hash base and of its inverse, grown on demand."""

    pow = _powers(_P, _SEGMENT + 1)
    inv = _powers(_PINV, _SEGMENT + 1)

    @classmethod
    def get(cls, n: int):
        if n > len(cls.pow):
            cls.pow, cls.inv = _powers(_P, 2 * n), _powers(_PINV, 2 * n)
        return cls.pow, cls.inv


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, off


def pieces(data: np.ndarray, off: np.ndarray, limit: int = 4 << 20):
    """Yield (first row, last row, bytes, offsets) of runs of whole rows with
    at most ``limit`` bytes; a longer row comes alone."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_bounds(data: np.ndarray, off: np.ndarray, in_word: np.ndarray = NOT_SPACE):
    """(starts, ends, words per row) of the maximal runs of bytes of ``in_word``
    that stay inside one row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    m = in_word[data]
    before = np.empty_like(m)
    before[0] = False
    before[1:] = m[:-1]
    first = off[:-1]
    before[first[first < len(data)]] = False
    after = np.empty_like(m)
    after[-1] = False
    after[:-1] = m[1:]
    last = off[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes (A-Z folded if ``lower``). Works through
    the bytes in segments, so memory does not grow with the text."""
    values = _BYTES_LOWER if lower else _BYTES
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(int(np.searchsorted(ends, starts[i] + _SEGMENT, "right")), i + 1)
        s0, e1 = int(starts[i]), int(ends[j - 1])
        pow_, inv = _Table.get(e1 - s0 + 1)
        c = np.empty(e1 - s0 + 1, np.uint64)
        c[0] = 0
        np.cumsum(values[data[s0:e1]] * pow_[:e1 - s0], out=c[1:])
        a = starts[i:j] - s0
        out[i:j] = (c[ends[i:j] - s0] - c[a]) * inv[a]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (len(words) - n + 1 of them)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(m, np.uint64)
    step = _SEGMENT
    for i in range(0, m, step):
        j = min(i + step, m)
        k = j - i + n - 1
        pow_, inv = _Table.get(k + 1)
        c = np.empty(k + 1, np.uint64)
        c[0] = 0
        np.cumsum(words[i:i + k] * pow_[:k], out=c[1:])
        out[i:j] = (c[n:n + j - i] - c[:j - i]) * inv[:j - i]
    return mix(out)
