"""Periodic runs of words: an enhanced suffix array and its branching-tandem test.

A run is a longest stretch of words with smallest period q that holds at
least ``min_exponent`` periods and ``min_length`` words.  Documents lie
one behind another in a batch, with alphabets of their own, so one suffix
array serves all of them and no match crosses a document:

1. Prefix doubling ranks all suffixes; only suffixes that still share a
   rank are sorted again.  The ranks of every round stay: equal ranks of
   round j mean equal stretches of 2**j words.
2. The longest common prefix of neighbours is read off those ranks when a
   round separates them.
3. LCP intervals are the spans between the next smaller values.  For every
   interval of depth d, each suffix i of all children but the largest
   looks up ISA[i + d] and ISA[i - d]: one inside the interval and outside
   i's child is a branching square of period d, the last square of a run.
   No tree nodes are made, and a suffix is looked at once per doubling of
   its interval, so the work is n log n.
4. The square is rotated left: by whole periods through ISA lookups, which
   drops what repeats too seldom, then to its leftmost word by the ranks.
   Squares of one stretch merge into a run with the least of their periods.

Every document is judged by the task that reads it; nothing is shuffled.

Defined results: a null or empty text, or one of blanks, has no words and
no runs; repeated rows are judged each; rows without doc_id are judged
like others; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import documents_of

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
OUT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _changes(keys: np.ndarray) -> np.ndarray:
    """Where a new key starts in ascending ``keys``."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def suffix_array(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffixes in order, LCP with the one before, and the ranks by 1, 2, 4, ... words.

    Rank arrays have one more place, for what lies behind the last word.
    """
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    lcp = np.zeros(n, np.int32)
    rank = np.full(n + 1, -1, np.int32)
    place = np.arange(n)
    new = _changes(key[order])
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    levels, k = [rank.copy()], 1
    alone = new & np.append(new[1:], True)
    place = place[~alone]
    while len(place):
        mine = order[place]
        old = rank[mine].astype(np.int64)
        key = old * (n + 1) + rank[np.minimum(mine + k, n)] + 1
        by = np.argsort(key, kind="stable")
        key, mine = key[by], mine[by]
        order[place] = mine
        new = _changes(key)
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        split = np.flatnonzero(new & ~_changes(key // (n + 1)))
        lcp[place[split]] = k + _common(levels[:-1], mine[split - 1] + k, mine[split] + k)
        rank[mine] = place[first]
        alone = new & np.append(new[1:], True)
        place = place[~alone]
        k *= 2
        levels.append(rank.copy())
    return order, lcp, levels


def _common(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of words shared by suffixes ``x`` and ``y``, known to be under 2 ** len(levels)."""
    got = np.zeros(len(x), np.int64)
    last = len(levels[0]) - 1 if levels else 0
    for j in range(len(levels) - 1, -1, -1):
        a, b = np.minimum(x + got, last), np.minimum(y + got, last)
        got += (levels[j][a] == levels[j][b]).astype(np.int64) << j
    return got


def _smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest places before and behind ``at`` with a smaller LCP (0 and len(lcp) hold one)."""
    n, value = len(lcp), lcp[at]
    widest = int(np.diff(np.concatenate([[0], np.flatnonzero(lcp == 0), [n]])).max())
    tables = [lcp]
    while 1 << len(tables) <= widest:
        t, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(t[:len(t) - half], t[half:]))
    low, high = at.copy(), at + 1
    for j in range(len(tables) - 1, -1, -1):
        t, step = tables[j], 1 << j
        to = low - step
        ok = to >= 0
        ok[ok] = t[to[ok]] >= value[ok]
        low[ok] = to[ok]
        ok = high + step <= n
        ok[ok] = t[high[ok]] >= value[ok]
        high[ok] += step
    return low - 1, high


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every range, one behind another."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _squares(order: np.ndarray, lcp: np.ndarray, isa: np.ndarray, longest: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching squares that ``min_exponent`` periods end with."""
    at = np.flatnonzero((lcp >= 1) & (lcp <= longest // min_exponent))
    if not len(at):
        return at, at
    low, high = _smaller(lcp, at)
    some = high - low >= min_exponent  # a period that often has as many occurrences
    at, low, high = at[some], low[some], high[some]
    if not len(at):
        return at, at
    # Splits of an interval share its first place and depth; a child lies between two of them.
    by = np.lexsort((at, lcp[at], low))
    at, low, high, depth = at[by], low[by], high[by], lcp[at[by]].astype(np.int64)
    opens = np.ones(len(at), bool)
    opens[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    nth = np.cumsum(opens) - 1
    firsts = np.flatnonzero(opens)
    place = np.arange(len(at)) + nth  # a group of m splits has m + 1 children
    first = np.empty(len(at) + len(firsts), np.int64)
    end = np.empty_like(first)
    first[place + 1] = at
    first[place[firsts]] = low[firsts]
    end[place] = at
    lasts = np.append(firsts[1:], len(at)) - 1
    end[place[lasts] + 1] = high[lasts]
    group = np.empty_like(first)
    group[place], group[place[lasts] + 1] = nth, nth[lasts]
    size = end - first
    heads = place[firsts]
    most = np.maximum.reduceat(size, heads)[group]
    top = np.flatnonzero(size == most)
    small = np.ones(len(size), bool)
    small[top[_changes(group[top])]] = False  # one largest child of each interval stays out
    first, end, size, group = first[small], end[small], size[small], group[small]
    suffix = order[_ranges(first, size)]
    child, inner = np.repeat(np.arange(len(first)), size), np.repeat(group, size)
    d, lo, hi = depth[firsts][inner], low[firsts][inner], high[firsts][inner]
    n = len(order)

    def inside(i, lo, hi):
        r = isa[np.where((i >= 0) & (i < n), i, n)]
        return r, (r >= lo) & (r < hi)

    found = []
    for other, start in ((suffix + d, suffix), (suffix - d, suffix - d)):
        r, ok = inside(other, lo, hi)
        ok &= (r < first[child]) | (r >= end[child])
        for k in range(1, min_exponent - 1):  # rotations by whole periods
            some = np.flatnonzero(ok)
            ok[some] = inside(start[some] - k * d[some], lo[some], hi[some])[1]
        found.append((start[ok], d[ok]))
    start, period = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((period, start))
    start, period = start[by], period[by]
    once = _changes(start)
    once[1:] |= period[1:] != period[:-1]
    return start[once], period[once]


def runs_of(ids: np.ndarray, doc: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period; ``doc`` numbers the words' documents in order."""
    none = np.zeros(0, np.int64)
    if not len(ids):
        return none, none, none
    order, lcp, levels = suffix_array(ids, doc)
    isa = np.full(len(ids) + 1, -1, np.int64)
    isa[order] = np.arange(len(ids))
    start, period = _squares(order, lcp, isa, int(np.bincount(doc).max()), min_exponent)
    end = start + 2 * period
    for j in range(len(levels) - 1, -1, -1):  # to the leftmost rotation
        to = start - (1 << j)
        ok = to >= 0
        ok[ok] = levels[j][to[ok]] == levels[j][(to + period)[ok]]
        start = np.where(ok, to, start)
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])  # larger periods of one stretch are multiples of its least
    keep &= end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[keep], end[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def _words(col) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column and the rows' offsets in them."""
    data, off = T.utf8(col)
    starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    body = data[T.BLANK_SPLIT[data]]
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)]), words


def _judged(part: pa.RecordBatch, min_length: int, min_exponent: int) -> pa.RecordBatch:
    words, off = _words(part.column(1))
    ids = words.dictionary_encode().indices.to_numpy()
    start, length, period = runs_of(ids, T.row_of(off), min_length, min_exponent)
    gone = T.covered(len(ids), start + period, length - period)
    stay = np.flatnonzero(~gone)
    kept = pa.ListArray.from_arrays(pa.array(np.searchsorted(stay, off), pa.int32()), words.take(pa.array(stay)))
    own = np.searchsorted(off, start, side="right") - 1
    runs = pa.StructArray.from_arrays([pa.array(start - off[own]), pa.array(length), pa.array(period)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, off), pa.int32()), runs)
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(off)), runs.cast(pa.list_(_RUN)),
                                       pc.binary_join(kept, " ")], schema=_OUT)


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, slice_bytes: int = 2 << 20) -> DataFrame:
    """Per document: doc_id, n_words, runs by start and period (in words), and the text with each run cut to one period."""
    if min_exponent < 2:
        raise ValueError("a run repeats: min_exponent must be 2 or more")

    def run(batches):
        for batch in batches:
            for part in T.slices(batch, "text", slice_bytes):
                yield _judged(part, min_length, min_exponent)

    return documents_of(docs).mapInArrow(run, OUT)


def _repeated(words: Column, g: Column) -> Column:
    n = F.size(words).cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    return F.array_join(F.transform(place, lambda i: F.get(words, i.cast("int"))), " ")


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """The contract's input: the words of a tenth of the documents repeat from some place on."""
    rows = documents_of(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))  # one array of words: cut once
    planted = F.transform(words, lambda w: F.when(F.size(w) > 0, _repeated(w, F.floor(h / 10).cast("long"))))[0]
    return rows.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), F.coalesce(planted, F.lit("")))
                       .otherwise(F.col("text")).alias("text"))


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op11``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","),
                                                  r.period.cast("string"), F.lit("\n")))
    out = result.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), line.alias("lines"), "collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
                      F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
