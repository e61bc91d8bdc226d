"""Quality rules: boosted trees over document statistics, with monotonic constraints.

``statistics`` computes the base figures of every whole text in one
vectorised pass.  ``fit`` grows gradient-boosted trees on a bounded
sample of labelled rows; a constrained feature may only push the score
one way.  The trees are flattened to node arrays, and a batch descends
all trees level by level.

Defined results: a null or blank text has no words and fails the base
rule; without labels the trees are empty and only the base rule
decides; rows are judged each, also repeated ones or such without
doc_id; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .common import documents_of
from .quality_classifier import labelled_sample

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
# Ratios the trees see, and the way each may push the score (0: free).
FEATURES = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "mark_share": -1,
            "word_length": 0, "digit_share": 0, "words_per_line": 0, "log_words": 1}
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS)])


def _table(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _UPPER, _DIGIT, _MARK = (_table(c) for c in (SYMBOLS.encode(), range(0x41, 0x5B), range(0x30, 0x3A), b"!?"))


def _twice(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keyed rows: those whose key occurs again in the same row; those that are not the key's only or first one."""
    if not len(h):
        return np.zeros(0, bool), np.zeros(0, bool)
    key = h ^ T.mix(rows.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:][same]] = True
    again[order[1:][same]] = again[order[:-1][same]] = True
    return again, later


def counts(col) -> list[np.ndarray]:
    """``_COUNTS`` of every row of a string column."""
    data, off = T.utf8(col)
    starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT)
    rows = T.row_of(words)
    n = len(off) - 1

    def per_row(mask):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[off[1:]] - total[off[:-1]]

    inside = T.BLANK_SPLIT[data]
    # Lines that hold a word, cut at line feeds and row ends.
    feed = np.flatnonzero(data == 0x0A)
    line_row = np.concatenate([np.arange(n), np.searchsorted(off, feed, side="right") - 1])
    line_start, line_end = np.concatenate([off[:-1], feed + 1]), np.concatenate([feed, off[1:]])
    order = np.lexsort((line_start, line_row))
    line_start, line_row = line_start[order], line_row[order]
    line_end = line_end[np.lexsort((line_end, np.concatenate([np.searchsorted(off, feed, side="right") - 1, np.arange(n)])))]
    total = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    full = total[line_end] > total[line_start]
    line_start, line_end, line_row = line_start[full], line_end[full], line_row[full]
    _, later = _twice(T.span_hashes(data, line_start, line_end), line_row)
    at = T.row_windows(rows, REPEAT_WINDOW)
    again, _ = _twice(T.rolling(T.span_hashes(data, starts, ends), REPEAT_WINDOW)[at], rows[at])
    repeat = T.covered(len(starts), at[again], REPEAT_WINDOW)
    by_word = np.concatenate([[0], np.cumsum(repeat)])
    return [np.diff(words), per_row(inside & ((data & 0xC0) != 0x80)), per_row(_SYMBOL[data]),
            np.bincount(line_row[later], minlength=n), by_word[words[1:]] - by_word[words[:-1]],
            np.bincount(line_row, minlength=n), per_row(_UPPER[data]), per_row(_DIGIT[data]), per_row(_MARK[data])]


def ratios(c: list[np.ndarray]) -> np.ndarray:
    """The trees' features, one row per document."""
    n_words, chars, symbols, dup, repeat, lines, upper, digits, marks = (np.asarray(x, np.float64) for x in c)
    w, ch, ln = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack([symbols / ch, dup / ln, repeat / w, upper / ch, marks / ch, chars / w, digits / ch, n_words / ln,
                     np.log1p(n_words)], axis=1)


def base_failed(c: list[np.ndarray]) -> np.ndarray:
    return (c[0] < 20) | (100 * c[4] > 30 * c[0])


@dataclass(frozen=True)
class Trees:
    """All trees as node arrays; a leaf's feature is -1 and it points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        at = np.tile(self.roots, (len(x), 1))
        for _ in range(self.depth):
            f = self.feature[at]
            low = np.take_along_axis(x, np.maximum(f, 0), axis=1) <= self.threshold[at]
            at = np.where(f < 0, at, np.where(low, self.left[at], self.right[at]))
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


EMPTY = Trees(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0), np.zeros(0, np.int64), 0, 0.0)


def boost(x: np.ndarray, y: np.ndarray, ways: list[int], rounds: int = 60, depth: int = 4, rate: float = 0.2,
          bins: int = 64, least: int = 20, l2: float = 1.0) -> Trees:
    """Histogram boosting on the logistic loss.

    A split of a constrained feature must order its sides' values that way, and
    its middle bounds all values below, which keeps every tree monotonic.
    """
    if not len(y):
        return EMPTY
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    total = np.full(len(y), base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v):
        feature.append(-1)
        threshold.append(0.0)
        left.append(len(left))
        right.append(len(right))
        value.append(v)
        return len(value) - 1

    def best(rows, g, h, low, high):
        found, gs, hs = (1e-6, None), g[rows].sum(), h[rows].sum()
        for f, way in enumerate(ways):
            k = len(cuts[f]) + 1
            b = binned[f][rows]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, minlength=k))[:-1] for w in (g[rows], h[rows], None))
            vl, vr = (np.clip(-a / (c + l2), low, high) for a, c in ((gl, hl), (gs - gl, hs - hl)))
            # Gain of taking these (bounded) values over taking none.
            gain = -(gl * vl + (hl + l2) * vl * vl / 2) - ((gs - gl) * vr + (hs - hl + l2) * vr * vr / 2)
            gain -= gs * gs / (hs + l2) / 2
            ok = (nl >= least) & (len(rows) - nl >= least) & ((vr - vl) * way >= 0)
            gain = np.where(ok, gain, -np.inf)
            if len(gain) and gain.max() > found[0]:
                i = int(gain.argmax())
                found = (gain[i], (f, i, vl[i], vr[i]))
        return found[1]

    def grow(rows, g, h, level, low, high):
        split = best(rows, g, h, low, high) if level < depth else None
        node = leaf(rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high)))
        if split is None:
            total[rows] += value[node]
            return node
        f, i, vl, vr = split
        mid, way = (vl + vr) / 2, ways[f]
        under = binned[f][rows] <= i
        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[way]
        feature[node], threshold[node] = f, float(cuts[f][i])
        left[node] = grow(rows[under], g, h, level + 1, *bounds[0])
        right[node] = grow(rows[~under], g, h, level + 1, *bounds[1])
        return node

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    return Trees(*(np.array(a, np.int64) if i != 1 else np.array(a) for i, a in enumerate((feature, threshold, left, right))),
                 np.array(value), np.array(roots, np.int64), depth, base)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``_COUNTS`` of every whole text."""
    def run(batches):
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in counts(part.column(1)))],
                                                 schema=_SCHEMA)

    return documents_of(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train_rows: int = 12_000) -> Trees:
    """Grow the trees on the statistics of a bounded sample of labelled rows (numbers only reach the driver)."""
    chosen = F.broadcast(labelled_sample(labels, label, max_train_rows))  # bounded by max_train_rows
    # A doc_id that rows or labels repeat counts once, so the bound holds for what is collected too.
    sample = documents_of(docs).join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("rank", "label", "text")).alias("s"))
    stats = statistics(sample.select("doc_id", "s.text")).join(chosen.groupBy("doc_id").agg(F.min(F.struct("rank", "label")).alias("l")), "doc_id")
    rows = sorted({tuple(r) for r in stats.select("l.rank", "l.label", *_COUNTS).collect()})
    data = np.array(rows, np.float64).reshape(-1, 2 + len(_COUNTS))
    return boost(ratios(list(data[:, 2:].T)), data[:, 1], list(FEATURES.values()))


def judge(spark: SparkSession, docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """doc_id, n_words, the base figures, base_failed, score and kept of every row."""
    shared = spark.sparkContext.broadcast(trees)
    schema = pa.schema([*list(_SCHEMA)[:6], ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for part in T.slices(batch, "text"):
                c = counts(part.column(1))
                failed, s = base_failed(c), shared.value.scores(ratios(c))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in c[:5]), pa.array(failed),
                     pa.array(~failed & (s >= threshold)), pa.array(s)], schema=schema)

    return documents_of(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS[:5])
                                         + ", base_failed boolean, kept boolean, score double")
