"""Columnar word and shingle hashing shared by the text operators.

Everything here works on a slice of an Arrow string column inside one task: the UTF-8 bytes are
viewed as numpy, word bounds come from one vectorised scan, and each word's 64-bit hash is the
difference of two prefix sums of a polynomial in the bytes. Nothing is per-word Python.

Words are ``[^\\x20\\x09-\\x0D]+``; upper-case ASCII folds to lower case when ``fold`` is set.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass holds; a longer single text makes a larger pass.
SLICE_BYTES = 1 << 19

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Any ASCII byte but letters and digits separates words here.
_MARKS = np.ones(256, dtype=bool)
_MARKS[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_FOLD = np.arange(1, 257, dtype=np.uint64)
_FOLD[ord("A") : ord("Z") + 1] += np.uint64(32)
_KEEP = np.arange(1, 257, dtype=np.uint64)

_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of a slice: byte bounds, hashes, and the row-wise bounds into them."""

    data: np.ndarray  # the slice's bytes
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last byte
    hash: np.ndarray  # uint64
    rows: np.ndarray  # row r holds words rows[r]:rows[r + 1]
    offsets: np.ndarray  # row r holds bytes offsets[r]:offsets[r + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and int64 row offsets, from zero; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, body = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column) or bounds is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True, marks: bool = False) -> Words:
    """Word bounds and hashes of the rows in ``data``; ``offsets`` starts at zero.

    With ``marks``, ASCII punctuation separates words as white space does.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), offsets)
    solid = ~(_MARKS if marks else _SPACE)[data]
    edge = np.zeros(n + 1, dtype=bool)  # a row starts here
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLD if fold else _KEEP)[data] * _power(_P, n), out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * _power(_P_INV, n)[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, hashed, np.searchsorted(start, offsets), offsets)


def each_slice(column: pa.Array | pa.ChunkedArray, fold: bool = True, marks: bool = False) -> Iterator[tuple[int, Words]]:
    """``(first row, words)`` of every slice of a column."""
    data, offsets = utf8(column)
    for a, b in slices(offsets):
        yield a, words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], fold, marks)


def grams(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive words, across row bounds too; len(hashed) - n + 1 of them."""
    if len(hashed) < n:
        return np.zeros(0, np.uint64)
    size = len(hashed) - n + 1
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x2545F4914F6CDD1D) + hashed[k : k + size]
    return mix(out)


def row_of(rows: np.ndarray, count: int) -> np.ndarray:
    """The row of each of ``count`` words."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:count]
