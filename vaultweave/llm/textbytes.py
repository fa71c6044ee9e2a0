"""Vectorised byte and word helpers for the operators that run numpy inside Spark tasks.

A *slab* is a run of whole texts laid end to end: ``data`` (uint8) and ``offs`` (int64, one more
entry than texts). Slabs bound the memory of a task: a slab holds at most ``SLAB_BYTES`` bytes, or
one single longer text. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 18

_U = np.uint64
_SEED = np.random.Generator(np.random.PCG64(20240607))
#: random value of each byte, and an odd base; hashes are polynomials modulo 2**64, then mixed
BYTE_VALUE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BASE = 0x9E3779B97F4A7C13
_BASE_INV = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLAB_BYTES + 1)
        for name, b in (("up", BASE), ("down", _BASE_INV)):
            p = np.full(size, _U(b))
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, xor, multiply)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, buf = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slabs(offs: np.ndarray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of consecutive texts with at most ``limit`` bytes (or one longer text)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Rolling:
    """Hashes of any substring of one slab in constant time."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=self._sum[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sum[end] - self._sum[start]) * self._down[start]

    def fixed(self, k: int) -> np.ndarray:
        """Hash of every substring of ``k`` bytes, by its start."""
        n = len(self._sum) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sum[k:] - self._sum[:n]) * self._down[:n] + _U(k))


def sliding(a: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over each window of ``w`` entries, by its start."""
    if len(a) < w:
        return a[:0]
    span, out = 1, a
    while 2 * span <= w:
        out = op(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = op(out[:len(a) - w + 1], out[w - span:w - span + len(a) - w + 1])
    return out


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words(data: np.ndarray, offs: np.ndarray, between=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slab: start, end and text of each, in order. ``between``: two
    properties of bytes; a word also ends where a byte with the first is followed by one with the second."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)  # a text starts here
    cut[offs] = True
    if between is not None:
        cut[1:-1] |= between[0][data[:-1]] & between[1][data[1:]]
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1
