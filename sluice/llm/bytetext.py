"""Vectorised word hashing over the byte buffers of Arrow string columns (numpy, inside Spark tasks).

A word is a maximal run of bytes that are not separators. Hashes are 64-bit: a polynomial over a fixed
random byte table, taken as differences of one running sum, then mixed with the length. Equal words have
equal hashes in every task; different words collide with probability about 2^-64 a pair.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything ASCII that is no letter: words are runs of letters and of bytes of non-ASCII characters.
NON_LETTERS = np.ones(256, dtype=bool)
NON_LETTERS[0x80:] = False
NON_LETTERS[0x41:0x5B] = False
NON_LETTERS[0x61:0x7B] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, on a uint64 array."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_TABLE = mix((np.arange(256, dtype=U64) + U64(1)) * U64(_P))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, dtype=U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def running_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLE[data] * _grown(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte range ``[start, end)`` of ``data`` (uint8); ``sums`` are its running sums where they are at hand."""
    if not len(starts):
        return np.zeros(0, U64)
    sums = running_sums(data) if sums is None else sums
    h = (sums[ends] - sums[starts]) * _grown(len(data) + 1)[1][starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of every window of ``width`` bytes: its polynomial brought to the same power, as adding and dropping a byte keeps it."""
    sums = running_sums(data)
    return (sums[width:] - sums[:-width]) * _grown(len(data) + 1)[1][: max(len(data) - width + 1, 0)]


def word_spans(data: np.ndarray, bounds: np.ndarray, seps: np.ndarray = SPACES):
    """``(starts, ends, first)``: byte ranges of all words, and the number of words before each document.

    ``bounds`` are the document limits in ``data`` (one more than there are documents); no word crosses one.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~seps[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    lo, hi = bounds[:-1], bounds[1:]
    full = hi > lo
    first[lo[full]] = inside[lo[full]]
    last[hi[full] - 1] = inside[hi[full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, bounds: np.ndarray, seps: np.ndarray = SPACES, fold: bool = True):
    """Hashes of all words and the number of words before each document; ``fold`` lower-cases A-Z first."""
    starts, ends, first = word_spans(data, bounds, seps)
    return range_hashes(LOWER[data] if fold else data, starts, ends), first


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words of one text (the whole text as one run where it is shorter; none of no words)."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U64)
    width = min(n, k)
    h = np.full(n - width + 1, U64(width), dtype=U64)
    for i in range(width):
        h = mix(h * U64(_P) + words[i: n - width + 1 + i])
    return h


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    raw = col.buffers()
    if len(col) == 0 or raw[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def text_chunks(col: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row_from, row_to, data, bounds)`` of consecutive rows, about ``limit`` bytes at a time (one row at least)."""
    data, offsets = buffers(col)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end
