"""Substring dedup: seed and extend over winnowed anchors.

1. *Seed.*  Every ``window``-word run selects one anchor, the smallest
   hash of its ``seed_words``-grams (winnowing), so equal runs select
   equal anchors.  Rows lie in groups of a bounded size; each group
   sends its distinct anchors once, which pre-aggregates a passage that
   a third of all rows share to one entry per group.  Anchors that meet
   another group come back.
2. *Extend.*  Around a shared anchor the match is extended both ways to
   each whole run that selected it; the group sends the hashes of that
   run with its smallest doc_id, and gets back those that start in a
   smaller document elsewhere.  Inside a group the seeds are the anchors
   that two of its documents hold, and the runs around them are compared
   where they lie.  So each repeat is found from a seed, at any size.
3. *Keep maximal repeats.*  Overlapping repeated runs merge to maximal
   spans, which are at least ``window`` words long.

Runs are equal when two independent 64-bit hashes of their words are.
Anchors only choose what is compared, so one hash is enough for them.
Hashes are dealt to buckets by their leading bits; the number of groups
and buckets follows the input, so that one task's share is bounded.
Rows are dealt to groups by their own number, so that rows without
doc_id, and rows that repeat one, spread like all others.  No pair of
documents is ever emitted.

Defined results: a null or blank text has no words and an empty kept
text; a text shorter than the window is kept; a row without doc_id is
kept whole and removes nothing; rows that repeat a doc_id are judged
each, and do not remove from one another; extra columns are ignored; no
rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import by_bucket, group_of, numbered, pieces, string_array

OUT = ("doc_id long, n_words long, n_removed long, kept_text string, "
       "spans array<struct<start:bigint,length:bigint>>")
SENT = "bucket int, grp long, keys binary, checks binary, firsts binary"
BACK = "grp long, keys binary, checks binary"
_SENT = pa.schema([("bucket", pa.int32()), ("grp", pa.int64()), ("keys", pa.binary()), ("checks", pa.binary()),
                   ("firsts", pa.binary())])
_BACK = pa.schema([("grp", pa.int64()), ("keys", pa.binary()), ("checks", pa.binary())])
_CHECK = np.uint64(0xA0761D6478BD642F)  # makes the second hash of a word from the first
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_text", pa.string()), ("spans", _SPANS)])


def _ids(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """doc_id of the rows (0 for none) and which rows have one."""
    col = part.column("doc_id")
    return col.fill_null(0).to_numpy(), col.is_valid().to_numpy()


def _hashes(h: np.ndarray, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the runs that start at words ``at``."""
    return T.rolling(h, window)[at], T.rolling(T.mix(h ^ _CHECK), window)[at]


def _runs(part: pa.Table, window: int, seed: int):
    """Both hashes, anchor and doc_id of every ``window``-word run of rows that have a doc_id."""
    data, off = T.utf8(part.column("text"))
    starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT)
    rows, h = T.row_of(words), T.span_hashes(data, starts, ends)
    at = T.row_windows(rows, window)
    ids, valid = _ids(part)
    at = at[valid[rows[at]]]
    grams = T.rolling(h, seed)
    n = max(0, len(h) - window + 1)
    anchor = grams[:n].copy()
    for j in range(1, window - seed + 1):
        np.minimum(anchor, grams[j:j + n], out=anchor)
    return *_hashes(h, window, at), anchor[at], ids[rows[at]]


def _near(part: pa.Table, window: int, seed: int, seeds: np.ndarray):
    """Both hashes and doc_id of the runs whose anchor is in the ascending ``seeds``."""
    got = []
    for s in T.slices(part, "text"):
        key, check, anchor, ids = _runs(s, window, seed)
        near = _among(anchor, seeds)
        got.append((key[near], check[near], ids[near]))
    return _joined_up(got, (np.uint64, np.uint64, np.int64))


def _anchors(part: pa.Table, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and doc_id of the group's runs; neighbours with the same of both count once."""
    got = []
    for s in T.slices(part, "text"):
        _, _, anchor, ids = _runs(s, window, seed)
        new = np.ones(len(ids), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (ids[1:] != ids[:-1])
        got.append((anchor[new], ids[new]))
    return _joined_up(got, (np.uint64, np.int64))


def _joined_up(got: list[tuple], kinds: tuple) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, k) for k in kinds]


def _held_twice(anchor: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ascending anchors that two documents hold."""
    order = np.lexsort((ids, anchor))
    anchor, ids = anchor[order], ids[order]
    return np.unique(anchor[1:][(anchor[1:] == anchor[:-1]) & (ids[1:] != ids[:-1])])


def _column(tbl: pa.Table, name: str, kind=np.uint64) -> np.ndarray:
    rows = [np.frombuffer(x, kind) for x in tbl.column(name).to_pylist()]
    return np.concatenate(rows) if rows else np.zeros(0, kind)


def _first(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs (ascending pairs of hashes) and the smallest id of each."""
    order = np.lexsort((ids, checks, keys))
    keys, checks, ids = keys[order], checks[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    return keys[new], checks[new], ids[new]


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the ascending array ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _place(keys: np.ndarray, checks: np.ndarray, known: np.ndarray, known_checks: np.ndarray) -> np.ndarray:
    """Place of each run among the ascending pairs of hashes, -1 for none."""
    at, out = np.searchsorted(known, keys), np.full(len(keys), -1)
    todo = np.flatnonzero(at < len(known))
    while len(todo):
        todo = todo[known[at[todo]] == keys[todo]]
        hit = known_checks[at[todo]] == checks[todo]
        out[todo[hit]] = at[todo[hit]]
        todo = todo[~hit]  # the same first hash and another second one: look at the next
        at[todo] += 1
        todo = todo[at[todo] < len(known)]
    return out


def _sent(grp: int, buckets: int, keys, checks=None, firsts=None) -> pa.Table:
    cuts = by_bucket(keys, buckets)
    rest = [[b"" if x is None else x[s:e].tobytes() for _, s, e in cuts] for x in (checks, firsts)]
    return pa.table([[b for b, _, _ in cuts], [grp] * len(cuts), [keys[s:e].tobytes() for _, s, e in cuts], *rest],
                    schema=_SENT)


def _back(parts: list[tuple]) -> pa.Table:
    parts = [p for p in parts if len(p[1])]
    return pa.table([[p[0] for p in parts], *([p[i].tobytes() for p in parts] for i in (1, 2))], schema=_BACK)


def repeats_removed(docs: DataFrame, window: int = 13, seed_words: int = 8,
                    group_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, spans (word start and length removed).

    A word goes when a ``window``-word run over it also starts in a
    document with a smaller doc_id.  ``seed_words`` is the anchors' length.
    """
    if not 0 < seed_words <= window:
        raise ValueError("seed_words must lie between 1 and window")
    n = pieces(docs, group_bytes)
    rows, row = numbered(docs.sparkSession, docs)
    grouped = rows.select(group_of(row, n).alias("grp"), rows["doc_id"].cast("long").alias("doc_id"),
                          rows["text"].cast("string").alias("text"))

    def anchors(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        return _sent(key[0].as_py(), n, np.unique(_anchors(part, window, seed_words)[0]))

    def shared(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        keys = np.sort(_column(part, "keys"))
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        rows = zip(part.column("grp").to_pylist(), part.column("keys").to_pylist())
        sent = ((g, np.frombuffer(x, np.uint64)) for g, x in rows)
        return _back([(g, k[_among(k, twice)], k[:0]) for g, k in sent])

    def extended(key: tuple[pa.Scalar, ...], part: pa.Table, seeds: pa.Table) -> pa.Table:
        return _sent(key[0].as_py(), n, *_first(*_near(part, window, seed_words, np.sort(_column(seeds, "keys")))))

    def earlier(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        sent = [_column(part, c, k) for c, k in (("keys", np.uint64), ("checks", np.uint64), ("firsts", np.int64))]
        keys, checks, least = _first(*sent)
        out, at = [], 0
        for g, size in zip(part.column("grp").to_pylist(), map(len, part.column("keys").to_pylist())):
            k, c, f = (x[at:at + size // 8] for x in sent)
            less = least[_place(k, c, keys, checks)] < f
            out.append((g, k[less], c[less]))
            at += size // 8
        return _back(out)

    def kept(key: tuple[pa.Scalar, ...], part: pa.Table, hits: pa.Table) -> pa.Table:
        if part.num_rows == 0:
            return _OUT.empty_table()
        again = _column(hits, "keys"), _column(hits, "checks")
        order = np.lexsort(again[::-1])
        seeds = _held_twice(*_anchors(part, window, seed_words))
        here = _first(*_near(part, window, seed_words, seeds))
        return pa.concat_tables([_cut(s, window, [x[order] for x in again], here) for s in T.slices(part, "text")])

    def _cut(part: pa.Table, window: int, again, here) -> pa.Table:
        data, off = T.utf8(part.column("text"))
        starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT)
        rows = T.row_of(words)
        at = T.row_windows(rows, window)
        ids, valid = _ids(part)
        at = at[valid[rows[at]]]
        runs = _hashes(T.span_hashes(data, starts, ends), window, at)
        hit = _place(*runs, *again) >= 0
        if len(here[0]):
            own = _place(*runs, *here[:2])
            hit |= (own >= 0) & (here[2][own] < ids[rows[at]])
        gone = T.covered(len(starts), at[hit], window)
        text, offsets = _joined(data, off, starts, ends, rows, gone)
        return pa.table([part.column("doc_id"), np.diff(words), _per_row(gone, words),
                         string_array(text, offsets), _spans(gone, rows, words)], schema=_OUT)

    seeds = grouped.groupBy("grp").applyInArrow(anchors, SENT).groupBy("bucket").applyInArrow(shared, BACK)
    hits = grouped.groupBy("grp").cogroup(seeds.groupBy("grp")).applyInArrow(extended, SENT) \
        .groupBy("bucket").applyInArrow(earlier, BACK)
    return grouped.groupBy("grp").cogroup(hits.groupBy("grp")).applyInArrow(kept, OUT)


def _per_row(mask: np.ndarray, words: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[words[1:]] - total[words[:-1]]


def _joined(data, off, starts, ends, rows, gone) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of the kept words, joined by one space."""
    stay = np.flatnonzero(~gone)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[stay]] += 1
    step[ends[stay]] -= 1
    mask = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    # The byte after a kept word is a separator when another kept word of the row follows.
    joint = ends[stay[:-1]][rows[stay[:-1]] == rows[stay[1:]]]
    text = data.copy()
    text[joint] = 0x20
    mask[joint] = True
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return text[mask], total[off]


def _spans(gone, rows, words) -> pa.Array:
    """Maximal removed spans per row, in words of the row."""
    n = len(gone)
    first, last = gone.copy(), gone.copy()
    if n:
        same = rows[1:] == rows[:-1]
        first[1:] &= ~(gone[:-1] & same)
        last[:-1] &= ~(gone[1:] & same)
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    inner = pa.StructArray.from_arrays([pa.array(s - words[:-1][rows[s]]), pa.array(e - s)], ["start", "length"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(s, words), pa.int32()), inner)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op1``."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
                         F.size("spans").cast("long").alias("n_spans"))
