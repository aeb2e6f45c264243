"""Words and word windows of whole Arrow text columns as numpy arrays, without a Python object per word.

A word is a run of bytes other than U+0020 and U+0009..U+000D. Words and windows are named by 64-bit
digests; two different ones share a digest with a chance of about 5e-20 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once, which bounds a task's memory whatever the batch holds.
CHUNK_BYTES = 2 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first row, bytes, row offsets) of as many whole rows as fit; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def find_words(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs of bytes not in ``gaps``, and each row's first (rows + 1 entries)."""
    inside = ~gaps[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begin[heads] = inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = inside[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest per word; of words of up to eight bytes it keeps every bit."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    keys = mix((sizes.astype(np.uint64) + np.uint64(1)) * _ODD)
    live = np.arange(len(starts))
    k = 0
    while len(live):
        part = eight[starts[live] + k] & _MASKS[np.minimum(sizes[live] - k, 8)]
        keys[live] = mix(keys[live] ^ part)
        k += 8
        live = live[sizes[live] > k]
    return keys


def window_keys(keys: np.ndarray, k: int) -> np.ndarray:
    """A digest of each run of ``k`` consecutive keys; runs over a row's end are for the caller to drop."""
    n = len(keys) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = _ODD
    for j in range(k):
        total += keys[j : j + n] * factor
        factor = np.uint64((int(factor) * 0xD1342543DE82EF95 + 2) & 0xFFFFFFFFFFFFFFFF) | np.uint64(1)
    return mix(total)


def chunk_keys(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word digests of a chunk and each row's first word."""
    if lower:
        data = LOWER[data]
    starts, ends, first = find_words(data, offsets)
    return word_keys(data, starts, ends), first
