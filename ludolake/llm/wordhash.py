"""64-bit hashes of the words of whole UTF-8 texts, in numpy on the bytes of Arrow columns.

A word is a maximal run of bytes that are no separators; bytes above 127 always belong to words. The
hash of a word is a polynomial in its bytes with odd base, taken as the difference of two prefix sums
modulo 2^64, so a block of text costs a few array operations and no Python object per word.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20      # bytes hashed at once
GROUP = 1 << 20      # bytes of the documents handed out together, one longer document alone

#: Functions that drop what another operator has remembered in this worker; workers serve many stages.
RELEASES: list[Callable[[], object]] = []


def trim() -> None:
    """Returns memory that this worker has freed, but its allocators still hold."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def give_back() -> None:
    """The same after a collection of what earlier work of this worker has left."""
    gc.collect()
    trim()

WHITE = bytes([0x20, *range(0x09, 0x0E)])
WHITE_AND_MARKS = WHITE + bytes(c for c in range(33, 127) if not chr(c).isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_POW = _powers(_BASE, BLOCK)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), BLOCK)
_PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] = _PLAIN[97:123]


class Words(NamedTuple):
    """Words of the rows ``first`` to ``last`` (exclusive) of a column, row after row."""

    first: int
    last: int
    hashes: np.ndarray   # uint64, one a word
    bounds: np.ndarray   # word positions where the rows begin, and the end
    starts: np.ndarray   # byte where the word begins in ``data``
    ends: np.ndarray
    data: np.ndarray     # bytes of the rows
    offsets: np.ndarray  # bytes where the rows begin in ``data``, and the end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def _separators(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = True
    return table


def _block_words(data, apart, row_starts, values):
    """Starts, ends and hashes of the words of one block; rows never share a word."""
    n = len(data)
    inside = ~apart
    first = inside.copy()
    first[1:] &= apart[:-1]
    last = inside.copy()
    last[:-1] &= apart[1:]
    cut = row_starts[(row_starts > 0) & (row_starts < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = (_POW, _INVERSE) if n <= BLOCK else (
        _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[:n], dtype=np.uint64, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def words(column: pa.Array, fold: bool = False, separators: bytes = WHITE) -> Iterator[Words]:
    """Words of all rows of a column, in groups of bounded bytes. ``fold`` lower-cases A-Z."""
    for release in RELEASES:
        release()
    data, offsets = text_bytes(column)
    table, values = _separators(separators), _FOLDED if fold else _PLAIN
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + GROUP, side="right")) - 1
        last = min(rows, max(last, first + 1))
        own, at = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        parts, begin = [], 0
        while begin < len(own):
            end = min(begin + BLOCK, len(own))
            while end < len(own):  # a block ends after a separator or at a row's end
                gap = np.flatnonzero(table[own[begin:end]])
                row = at[np.searchsorted(at, end, side="right") - 1]
                at_most = max(begin + int(gap[-1]) + 1 if len(gap) else 0, int(row))
                if at_most > begin:
                    end = at_most
                    break
                end = min(end + BLOCK, len(own))
            block = own[begin:end]
            s, e, h = _block_words(block, table[block], at - begin, values)
            parts.append((s + begin, e + begin, h))
            begin = end
        starts, ends, hashes = (np.concatenate(x) for x in zip(*parts)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        yield Words(first, last, hashes, np.searchsorted(starts, at), starts, ends, own, at)
        first = last
    trim()  # workers that wait for other stages hold nothing back


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; one entry for each word that begins such a run."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(_powers(0xC2B2AE3D27D4EB4F, size + 1)[1:]):
        out += hashes[k:k + n] * factor
    return mix(out)
