"""Numpy helpers that work on many texts at once: words, rolling hashes, window minima.

All hashes are polynomials modulo 2**64 over mixed symbols, taken from prefix sums, so that the hash
of any window costs two lookups. Texts are handled as slices of bounded size (``SLICE`` bytes or
symbols), which bounds memory whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1342543DE82EF95)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits (a bijection)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=4)
def _powers(base: int, inverse: bool, size: int) -> np.ndarray:
    value = pow(base, -1, 1 << 64) if inverse else base
    out = np.full(size, value, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: np.uint64, count: int, inverse: bool = False) -> np.ndarray:
    size = max(SLICE * 2, 1 << max(count - 1, 1).bit_length())
    return _powers(int(base), inverse, size)[:count]


def prefix(symbols: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Prefix sums of symbol times power; entry i covers the first i symbols. Bytes count by their codes."""
    if symbols.dtype == np.uint8:
        symbols = BYTE_CODES[symbols]
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * powers(base, len(symbols)), out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of symbols[start:end] for arrays of bounds."""
    return mix((sums[end] - sums[start]) * powers(base, len(sums), True)[start])


def windows_hash(symbols: np.ndarray, width: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of every window of ``width`` symbols."""
    count = len(symbols) - width + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = prefix(symbols, base)
    return mix((sums[width:] - sums[:count]) * powers(base, count, True))


def windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, by doubling."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:count], low[width - span : width - span + count])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    low = offsets[0] if len(offsets) else 0
    return data[low : offsets[-1] if len(offsets) else 0], offsets - low


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of whole rows with at most ``limit`` bytes, or one longer row alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, a run of bytes other than space and \\t to \\r, within its row."""
    solid = ~_SPACE[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit code per word: the sum of its eight-byte parts, each mixed with its place, mixed with the length.

    No polynomial of the bytes, so words that collide modulo a power of two whatever the base have codes of
    their own. Bytes are taken in slices, so a long row needs little memory beyond its longest word.
    """
    out = np.empty(len(start), dtype=np.uint64)
    first = 0
    while first < len(start):
        base = start[first]
        last = max(int(np.searchsorted(end, base + SLICE, side="right")), first + 1)
        part = np.concatenate([data[base : end[last - 1]], np.zeros(8, dtype=np.uint8)])
        eights = np.ndarray((len(part) - 7,), dtype="<u8", buffer=part.data, strides=(1,))
        low, size = start[first:last] - base, end[first:last] - start[first:last]
        many = (size + 7) // 8
        opens = np.cumsum(many) - many
        place = np.arange(many.sum()) - np.repeat(opens, many)
        held = eights[np.repeat(low, many) + 8 * place]
        left = np.repeat(size, many) - 8 * place  # bytes of the word from here on
        held = np.where(left < 8, held & ((np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1)), held)
        mixed = mix(held ^ mix(place.astype(np.uint64) * _BASE + _SECOND))
        out[first:last] = mix(np.add.reduceat(mixed, opens) + size.astype(np.uint64))
        first = last
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def runs(values: np.ndarray) -> np.ndarray:
    """First index of every run of equal values."""
    if not len(values):
        return np.empty(0, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
