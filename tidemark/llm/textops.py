"""Word-level numpy kernels over Arrow string columns.

All kernels work on the UTF-8 buffer of a whole Arrow batch at once: no
Python loop per row.  A separator is always an ASCII byte, so byte
offsets are word offsets for any UTF-8 text.  Byte-sized temporaries of
64-bit type are made for at most ``CHUNK`` bytes at a time, so a very
long text costs no more memory than a few words per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK = 1 << 20
_HASHED = 1 << 16  # bytes that are hashed at a time: their 64-bit temporaries stay in a core's cache
_BASE = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_ROLL = U64(0xD6E8FEB86659FD93)

# Words of the contracts: runs of anything but space and TAB..CR.
BLANK_SPLIT = np.ones(256, dtype=bool)
BLANK_SPLIT[[0x20, *range(0x09, 0x0E)]] = False
# Runs of ASCII letters, digits and every non-ASCII character.
ALNUM_SPLIT = np.zeros(256, dtype=bool)
ALNUM_SPLIT[0x30:0x3A] = ALNUM_SPLIT[0x41:0x5B] = ALNUM_SPLIT[0x61:0x7B] = ALNUM_SPLIT[0x80:] = True
# Lower-case A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


_POW, _IPOW = _powers(_BASE, CHUNK + 1), _powers(_INV, CHUNK + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if isinstance(col, pa.ChunkedArray):  # no rows at all
        col = pa.array([], pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=kind, count=len(col) + 1, offset=col.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` for bytes and a table of 256 bytes or booleans, without an index of eight times the size."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def slices(batch: pa.RecordBatch | pa.Table, column: str, max_bytes: int = 4 << 20) -> Iterator:
    """Row slices of ``batch`` with at most ``max_bytes`` of text (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(batch.schema.get_field_index(column))
    _, off = utf8(col)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def word_bounds(data: np.ndarray, off: np.ndarray, table: np.ndarray,
                cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's offset in them.

    ``cut`` marks bytes at which a word is also divided in two.
    """
    inside = mapped(data, table)
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    first = inside & ~before
    if cut is not None:
        first |= cut & inside
    starts = np.flatnonzero(first)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = off[1:][off[1:] > 0] - 1
    after[last] = False
    final = inside & ~after
    if cut is not None:
        final[:-1] |= (cut & inside)[1:] & inside[:-1]
    ends = np.flatnonzero(final) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (ascending, non-overlapping spans)."""
    out = np.empty(len(starts), dtype=U64)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _HASHED, side="right")))
        hi = int(ends[j - 1])
        pw, ipw = (_POW, _IPOW) if hi - lo <= CHUNK else (_powers(_BASE, hi - lo + 1), _powers(_INV, hi - lo + 1))
        acc = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum((data[lo:hi].astype(U64) + U64(1)) * pw[:hi - lo], out=acc[1:], dtype=U64)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((acc[e] - acc[s]) * ipw[s])
        i = j
    return out


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive items (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= _ROLL
        acc += h[j:j + n]
    return mix(acc)


def row_of(word_off: np.ndarray) -> np.ndarray:
    """Row index of every word."""
    return np.repeat(np.arange(len(word_off) - 1), np.diff(word_off))


def row_windows(rows: np.ndarray, k: int) -> np.ndarray:
    """Starts of the ``k``-word windows that lie inside one row."""
    n = len(rows) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(rows[:n] == rows[k - 1:])


def covered(n: int, starts: np.ndarray, length) -> np.ndarray:
    """Mask of the ``n`` words that lie in any span [start, start + length)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + length, -1)
    return np.cumsum(delta[:-1]) > 0
