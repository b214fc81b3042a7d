"""Vectorised text kernels over Arrow string columns.

All kernels work on the UTF-8 bytes of many texts at once (a *slab*), so the cost a text is
numpy's and not the interpreter's. A slab holds a few MB, or a single longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text in one slab; a longer text is a slab of its own.
SLAB_BYTES = 2 << 20
_U = np.uint64
_M64 = (1 << 64) - 1
#: Odd multiplier of the polynomial range hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)

WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of alphanumeric words: ASCII that is neither digit nor letter. Other bytes are word bytes.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


class Slab(NamedTuple):
    """Rows [lo, hi) of a column: their bytes one after another, where each row starts, which are not null."""

    lo: int
    hi: int
    data: np.ndarray
    offs: np.ndarray
    valid: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo


def slabs(col: pa.Array, max_bytes: int = SLAB_BYTES) -> Iterator[Slab]:
    """Cut a string or binary column into slabs. Null rows have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off_buf, data_buf = col.buffers()
    offs = np.frombuffer(off_buf, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    valid = np.asarray(col.is_valid())
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield Slab(lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], valid[lo:hi])
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = np.array(x, np.uint64)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def mix1(x: int) -> int:
    x &= _M64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M64
    return x ^ (x >> 31)


_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _pow.get("up")
    if have is None or len(have) < n:
        n = max(n, SLAB_BYTES + 2)
        for k, b in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(n, _U(b), np.uint64)
            p[0] = 1
            _pow[k] = np.multiply.accumulate(p)
    return _pow["up"], _pow["down"]


class RangeHash:
    """64-bit hashes of byte ranges of one buffer, each in constant time after one pass."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])
        if len(_pow["up"]) > 4 * SLAB_BYTES:  # tables for one very long text are not kept
            _pow.clear()

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of every range of ``size`` bytes, by start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


class Words(NamedTuple):
    """Words of a slab: byte ranges, the row of each, and where each row's words begin (n + 1 entries)."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> Words:
    """Maximal runs of bytes outside ``sep``; runs never cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(len(offs), np.int64))
    inside = ~sep[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    edge[0] = edge[n] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(offs, starts, "right") - 1
    first = np.searchsorted(starts, offs, "left")
    return Words(starts, ends, row, first)


_STEP = [mix1(0x5851F42D4C957F2D * (i + 1)) | 1 for i in range(64)]


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive entries of ``h``, by first entry (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += h[i : i + n] * _U(_STEP[i % 64] + 2 * (i // 64))
    return mix(out)


def whole(h: np.ndarray) -> int:
    """The hash of a full sequence, its length included."""
    s = mix1(len(h) * 0xA0761D6478BD642F)
    for x in h.tolist():
        s = mix1(s * 31 + x)
    return s


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count of code points before each byte (len + 1 entries)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def coverage(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:n]) > 0


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def shingles(w: Words, h: np.ndarray, i: int, k: int) -> np.ndarray:
    """Distinct hashes of row i's k-word shingles; all of its words as one where it has fewer than k."""
    a, b = int(w.first[i]), int(w.first[i + 1])
    if a == b:
        return np.zeros(0, np.uint64)
    if b - a < k:
        return np.array([whole(h[a:b])], np.uint64)
    return np.unique(runs(h[a:b], k))
