"""Numpy views of Arrow text columns: bytes, words and word hashes of many documents at once.

Every function works on one *slice*: some rows of an Arrow batch whose texts lie one after the other in a byte buffer.
A slice holds about ``limit`` bytes, or one longer text, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = [np.ones(1, U64), np.ones(1, U64)]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, offsets)`` of runs of rows of about ``limit`` bytes."""
    data, at = text_buffer(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first word of each row and the total)`` of the words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: equal bytes give equal hashes wherever they lie."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def span_checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number made of a span's first eight bytes and its length: spans of one hash are still told apart by it."""
    heads = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))[starts]
    width = np.minimum(ends - starts, 8).astype(U64)
    return (heads << (U64(64) - width * U64(8))) ^ (ends - starts).astype(U64)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of ``words[i:i+n]`` for each i.  Built by doubling, so a window of 2k words is made of two of k words."""
    if len(words) < n:
        return np.zeros(0, U64)
    h, have, weight = words, 1, _BASE
    while have * 2 <= n:
        h = h[:-have] * weight + h[have:] if have < len(h) else h[:0]
        weight, have = U64(int(weight) ** 2 % (1 << 64)), have * 2
    for k in range(have, n):
        h = h[: len(words) - k] * _BASE + words[k:]
    return mix(h[: len(words) - n + 1])


def sequence_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``words[start:end]`` for spans of any lengths: equal words give equal hashes wherever they lie."""
    up, down = _power(len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def row_of(firsts: np.ndarray) -> np.ndarray:
    """The row of each element, given where the rows' elements begin (and the total)."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
