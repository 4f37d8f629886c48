"""Vectorised text helpers that run inside Spark tasks (numpy over Arrow buffers).

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, so a word never
crosses a document and UTF-8 sequences stay whole. Every helper takes the bytes
of a block of documents and their offsets; nothing here touches Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of one numpy block; a longer document is a block of its own.
BLOCK_BYTES = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.default_rng(20240811)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2**64; the table is kept and grown."""
    global _powers
    if len(_powers) <= n:
        table = np.full(max(n + 1, BLOCK_BYTES + 1), _BASE, dtype=np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offs


def blocks(offs: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, at least one row each."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


#: Byte kinds: 0 space, 1 letters, digits and bytes above ASCII, 2 other signs.
_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[_SPACE] = 0
_KIND[0x80:] = 1
for _range in (range(48, 58), range(65, 91), range(97, 123)):
    _KIND[list(_range)] = 1


def words(buf: np.ndarray, offs: np.ndarray, lower: bool = False,
          by_kind: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, word start bytes, and the first word index of each document.

    ``buf`` is one block, ``offs`` its document offsets starting at 0. The third
    array has one entry more than there are documents. With ``by_kind`` a word also
    ends where letters or digits meet other signs.
    """
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    kind = _KIND[buf] if by_kind else (~_SPACE[buf]).astype(np.uint8)
    change = np.ones(n + 1, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offs] = True
    inside = kind != 0
    starts = np.flatnonzero(change[:-1] & inside)
    ends = np.flatnonzero(change[1:] & inside) + 1
    pw = powers(n)
    values = _BYTE_VALUE[_LOWER[buf]] if lower else _BYTE_VALUE[buf]
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * pw[:n], out=total[1:])
    # scaled to the exponent of a full block, so a word's hash does not depend on its place
    hashes = mix((total[ends] - total[starts]) * pw[n - starts] * base_to(BLOCK_BYTES - n))
    first = np.searchsorted(starts, offs)
    return hashes, starts, first


def base_to(k: int) -> np.uint64:
    """``base ** k`` modulo 2**64; a negative ``k`` takes the inverse of the odd base."""
    return np.uint64(pow(int(_BASE), k, 1 << 64))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for every window of ``size`` words (order matters)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[k:k + n])
    return out


class Prefix:
    """Prefix sums of one text, from which any byte range is hashed in constant time."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.n, self.pw = n, powers(n)
        self.total = np.empty(n + 1, dtype=np.uint64)
        self.total[0] = 0
        np.cumsum(_BYTE_VALUE[buf] * self.pw[:n], out=self.total[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal bytes, wherever they stand."""
        return mix((self.total[ends] - self.total[starts]) * self.pw[self.n - starts]
                   * base_to(BLOCK_BYTES - self.n))

    def grams(self, size: int) -> np.ndarray:
        """One hash for the ``size`` bytes that start at every byte."""
        count = self.n - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        sums = self.total[size:] - self.total[:count]
        sums *= self.pw[self.n - count + 1:self.n + 1][::-1]
        return mix(sums * base_to(BLOCK_BYTES - self.n))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in linear time."""
    n = len(values)
    if n < width:
        return np.zeros(0, values.dtype)
    blocks_ = -(-n // width)
    padded = np.full(blocks_ * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks_, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])
