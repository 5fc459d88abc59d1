"""Terms of Arrow string columns as 64-bit hashes, for any single-byte gaps.

A term is a maximal run of bytes that are not gaps; gaps are ASCII, so no
character is cut. Rows are read in slices of about a megabyte and long rows in
chunks cut at a gap, so a worker holds a few arrays of that size and 40 bytes
a term, however long the texts are."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .words import mix, powers, string_buffers

_U = np.uint64
_CHUNK = 1 << 20
_ROW_END = 0x0A  # put behind every row; has to be a gap
_COEF = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))
_LOWER = _COEF.copy()
_LOWER[ord("A"):ord("Z") + 1] = _COEF[ord("a"):ord("z") + 1]


def byte_set(*parts: int | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for p in parts:
        table[p if isinstance(p, int) else np.asarray(p)] = True
    return table


@dataclass
class Terms:
    """Terms of some rows in order: hash, row, first byte and end in ``data``,
    and the number of breaks before (row ends count as breaks)."""
    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    data: np.ndarray

    def text(self, k: int) -> bytes:
        """The bytes of term ``k``, with A-Z in lower case."""
        return self.data[self.starts[k]:self.ends[k]].tobytes().lower()


def row_slices(batch: pa.RecordBatch, column: int, size: int = _CHUNK):
    """The batch in slices of rows whose texts have about ``size`` bytes."""
    _, offsets = string_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def terms_of(col: pa.Array, gaps: np.ndarray, breaks: np.ndarray | None = None, seed: int = 0) -> Terms:
    """Terms of a string column (a null has none), hashed with A-Z in lower case."""
    text, offsets = string_buffers(col)
    rows = len(offsets) - 1
    data = np.full(len(text) + rows, _ROW_END, dtype=np.uint8)
    is_text = np.ones(len(data), dtype=bool)
    row_ends = offsets[1:] + np.arange(rows)
    is_text[row_ends] = False
    data[is_text] = text
    gap = gaps.copy()
    gap[_ROW_END] = True
    if breaks is None:
        breaks = byte_set(_ROW_END)
    found, at, done = [], 0, 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        while end < len(data) and not gap[data[end - 1]]:  # up to the next gap
            rest = np.flatnonzero(gap[data[end:end + _CHUNK]])
            end = end + int(rest[0]) + 1 if len(rest) else min(len(data), end + _CHUNK)
        found.append((*_chunk(data[at:end], gap, breaks, seed), at, done))
        done += found[-1][3]
        at = end
    empty = np.zeros(0, np.int64)
    hashes = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
    starts = np.concatenate([f[1] + f[5] for f in found]) if found else empty
    ends = np.concatenate([f[2] + f[5] for f in found]) if found else empty
    piece = np.concatenate([f[4] + f[6] for f in found]) if found else empty
    return Terms(hashes, np.searchsorted(row_ends, starts), starts, ends, piece, data)


def _chunk(b: np.ndarray, gap: np.ndarray, breaks: np.ndarray, seed: int):
    is_gap = gap[b]
    edge = np.empty(len(b) + 1, dtype=bool)
    edge[0], edge[-1] = not is_gap[0], not is_gap[-1]
    np.not_equal(is_gap[1:], is_gap[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    starts, ends = at[::2], at[1::2]
    p, q = powers(len(b) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_LOWER[b] * p[:len(b)], out=total[1:])
        hashes = mix(mix((total[ends] - total[starts]) * q[starts] + _U(seed)) + (ends - starts).astype(np.uint64))
    before = np.cumsum(breaks[b], dtype=np.int64)
    return hashes, starts, ends, int(before[-1]), before[starts]
