"""Patched frame-of-reference blocks of unsigned ids, in numpy.

A block holds up to ``BLOCK`` ids: the block minimum is subtracted, the
rest is packed at the width that a given percentile of the block needs,
and larger values go to the block's exception list.

File layout, little endian::

    magic 8 bytes | u32 block length | u32 rows without id | u64 rows | u64 ids | u64 blocks
    i64 doc_id per row | u64 first id per row, and the total
    u64 first byte of each block, and the end          (the block index)
    blocks: u32 minimum | u8 width | u8 exceptions | packed bits | u8 positions | u32 values
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 128
MAGIC = b"TMPFOR01"
_HEAD = struct.Struct("<8sIIQQQ")
_FIXED = 6  # bytes of minimum, width and number of exceptions
_STEP = 4096  # blocks that are handled at a time


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack_blocks(ids: np.ndarray, percentile: float = 0.9) -> tuple[bytes, np.ndarray]:
    """The blocks' bytes, and the first byte of each block and the end."""
    ids = np.asarray(ids, np.uint32)
    n = -(-len(ids) // BLOCK)
    out, sizes = [], []
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    for b in range(0, n, _STEP):
        part = ids[b * BLOCK:(b + _STEP) * BLOCK]
        if pad := -len(part) % BLOCK:
            part = np.concatenate([part, np.full(pad, part[-1], np.uint32)])
        part = part.reshape(-1, BLOCK)
        low = part.min(axis=1)
        rest = part - low[:, None]
        need = _bits(rest)
        width = np.partition(need, rank, axis=1)[:, rank]
        odd = need > width[:, None]
        n_odd = odd.sum(axis=1)
        size = _FIXED + width.astype(np.int64) * (BLOCK // 8) + 5 * n_odd
        at = np.concatenate([[0], np.cumsum(size)])
        raw = np.zeros(at[-1], np.uint8)
        raw[at[:-1, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
        raw[at[:-1] + 4], raw[at[:-1] + 5] = width, n_odd
        for w in np.unique(width[width > 0]):
            own = np.flatnonzero(width == w)
            bits = np.unpackbits(rest[own].astype(">u4").view(np.uint8).reshape(len(own), BLOCK, 4), axis=2)
            packed = np.packbits(bits[:, :, 32 - w:].reshape(len(own), -1), axis=1)
            raw[at[own, None] + _FIXED + np.arange(packed.shape[1])] = packed
        if n_odd.any():
            blk, pos = np.nonzero(odd)
            k = np.arange(len(blk)) - np.concatenate([[0], np.cumsum(n_odd)])[blk]
            start = at[blk] + _FIXED + width[blk].astype(np.int64) * (BLOCK // 8)
            raw[start + k] = pos
            raw[(start + n_odd[blk] + 4 * k)[:, None] + np.arange(4)] = \
                rest[blk, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
        out.append(raw.tobytes())
        sizes.append(size)
    index = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
    return b"".join(out), index.astype(np.uint64)


def unpack_blocks(raw: np.ndarray, index: np.ndarray, n_ids: int) -> np.ndarray:
    """Ids of the blocks that ``index`` bounds in ``raw``."""
    out = np.empty((len(index) - 1, BLOCK), np.uint32)
    for b in range(0, len(out), _STEP):
        at = index[b:b + _STEP + 1].astype(np.int64)[:-1]
        low = raw[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
        width, n_odd = raw[at + 4], raw[at + 5].astype(np.int64)
        rest = np.zeros((len(at), BLOCK), np.uint32)
        for w in np.unique(width[width > 0]):
            own = np.flatnonzero(width == w)
            packed = raw[at[own, None] + _FIXED + np.arange(int(w) * BLOCK // 8)]
            bits = np.zeros((len(own), BLOCK, 32), np.uint8)
            bits[:, :, 32 - w:] = np.unpackbits(packed, axis=1).reshape(len(own), BLOCK, w)
            rest[own] = np.packbits(bits, axis=2).view(">u4").reshape(len(own), BLOCK)
        if n_odd.any():
            blk = np.repeat(np.arange(len(at)), n_odd)
            k = np.arange(len(blk)) - np.repeat(np.concatenate([[0], np.cumsum(n_odd)])[:-1], n_odd)
            start = at[blk] + _FIXED + width[blk].astype(np.int64) * (BLOCK // 8)
            values = raw[(start + n_odd[blk] + 4 * k)[:, None] + np.arange(4)].copy().view("<u4").ravel()
            rest[blk, raw[start + k]] = values
        out[b:b + len(at)] = rest + low[:, None]
    return out.ravel()[:n_ids]


def to_file(doc_ids: np.ndarray, n_null: int, starts: np.ndarray, ids: np.ndarray, percentile: float = 0.9) -> bytes:
    body, index = pack_blocks(ids, percentile)
    head = _HEAD.pack(MAGIC, BLOCK, n_null, len(doc_ids), len(ids), len(index) - 1)
    fixed = [head, doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes()]
    first = sum(map(len, fixed)) + 8 * len(index)
    return b"".join([*fixed, (index + np.uint64(first)).astype("<u8").tobytes(), body])


def from_file(content: bytes) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """doc_ids, number of leading rows without one, first id of each row and the total, ids."""
    magic, block, n_null, rows, n_ids, blocks = _HEAD.unpack_from(content)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token file of this format")
    at = _HEAD.size
    doc_ids = np.frombuffer(content, "<i8", rows, at)
    starts = np.frombuffer(content, "<u8", rows + 1, at + 8 * rows).astype(np.int64)
    index = np.frombuffer(content, "<u8", blocks + 1, at + 16 * rows + 8)
    return doc_ids, n_null, starts, unpack_blocks(np.frombuffer(content, np.uint8), index, n_ids)
