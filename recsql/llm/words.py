"""Vectorised word hashing over Arrow string buffers.

Words are maximal runs of bytes other than space and \\t..\\r, that is
``[^\\x20\\x09-\\x0D]+``; those bytes never occur inside a multi-byte UTF-8
character. Each word gets a 64-bit hash: a polynomial over per-byte random
coefficients modulo 2^64, read off one prefix sum per chunk, then mixed. The
work per byte is a handful of NumPy passes and no Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator (a bijection on 64-bit values)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_COEF = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_COEF_LOWER = _COEF.copy()
_COEF_LOWER[ord("A"):ord("Z") + 1] = _COEF[ord("a"):ord("z") + 1]
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(n, _CHUNK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for name, base in (("p", _BASE), ("q", inverse)):
                steps = np.full(size, _U(base), dtype=np.uint64)
                steps[0] = 1
                _POWERS[name] = np.cumprod(steps)
    return _POWERS["p"], _POWERS["q"]


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column in order, and each row's first word
    position (one entry more than rows)."""
    data, offsets = string_buffers(col)
    coef = _COEF_LOWER if lower else _COEF
    n = len(data)
    hashes, starts = [], []
    at = 0
    bounds = np.unique(offsets)
    while at < n:
        end = min(n, at + _CHUNK)
        if end < n:  # cut before a separator or at a row's end, never inside a word
            row_end = int(bounds[np.searchsorted(bounds, end, side="right") - 1])
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            gap = at + int(gaps[-1]) if len(gaps) else at
            cut = max(row_end, gap)
            if cut <= at:  # one word longer than a chunk: take it whole
                rest = np.flatnonzero(_SPACE[data[end:]])
                stop = end + int(rest[0]) if len(rest) else n
                cut = min(stop, int(bounds[np.searchsorted(bounds, at, side="right")]))
            end = cut
        h, s = _chunk(data[at:end], bounds, at, coef)
        hashes.append(h)
        starts.append(s)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(start, offsets, side="left")


def _chunk(b: np.ndarray, bounds: np.ndarray, at: int, coef: np.ndarray):
    n = len(b)
    gap = _SPACE[b]
    edge = np.zeros(n + 1, dtype=bool)  # a row begins at this byte
    lo, hi = np.searchsorted(bounds, [at, at + n])
    edge[bounds[lo:hi] - at] = True
    edge[0] = edge[n] = True
    word = ~gap
    begin = word.copy()
    begin[1:] &= gap[:-1] | edge[1:n]
    final = word.copy()
    final[:-1] &= gap[1:] | edge[1:n]
    s = np.flatnonzero(begin)
    e = np.flatnonzero(final) + 1
    p, q = powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(coef[b] * p[:n], out=total[1:])
        return mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64)), s + at


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (the last n - 1 are cut off)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(m, _U(n), dtype=np.uint64)
        for k in range(n):
            out = out * _U(0xD6E8FEB86659FD93) + words[k:k + m]
            out ^= out >> _U(32)
    return mix(out)
