"""Hard negatives of anchor vectors by a secondary-sort shuffle.

1. Vectors are quantised to integers and written in files of ``file_rows``
   rows; anchors also go to files of their own.  The files are dealt to at
   most ``row_groups`` groups, so what a task hands on per anchor does not
   grow with the table.
2. Every block of anchors is scored against every group of rows (matrix
   products, exact in integers) and keeps an anchor's best rows of its own
   label; a block's parts give its positives, written to a file.
3. The blocks are scored again with the positives known: an anchor keeps,
   for each positive, the first rows of another label in that positive's
   window of scores.
4. Positives and candidates are packed into (anchor, descending score, id)
   keys, dealt by anchor and sorted within partitions
   (repartitionAndSortWithinPartitions).  One pass over the sorted keys
   opens a window at each positive and emits the negatives that reach it;
   it holds one anchor's open windows and nothing else.

No pair is handed on but these candidates, so hot labels or vectors that a
third of the rows share cost no more than others; files and shuffles
survive lost executors.

Defined results: rows without id, label or vector, or with a null or
non-finite component, take no part; equal scores go by the smaller id,
then by the row's place; repeated rows are rows each, also as anchors;
shorter vectors count as ending in zeros; an anchor without positives, or
a positive with an empty window, gives no rows; an empty table gives none;
extra columns are ignored.  Components too large for a 64-bit product are
refused.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrays_of, scratch_path, stored
from .token_store import put

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FILES = pa.schema([("kind", pa.string()), ("path", pa.string()), ("n", pa.int64())])
_BEST = pa.schema([("block", pa.int64()), *((c, pa.int64()) for c in ("anchor", "score", "id", "row"))])
_KEYS = pa.schema([("key", pa.binary())])
_KEY = np.dtype([(c, ">u8") for c in ("anchor", "anchor_id", "score")] + [("kind", "u1")] + [(c, ">u8") for c in ("id", "row")])
_UNPACK = struct.Struct(">QQQBQQ").unpack
_SIGN = 1 << 63


def usable(rows: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", anchor: Column | None = None) -> DataFrame:
    """id, label, vector, anchor (whether the row is one) and row (its number) of the rows that take part."""
    known = rows.select(rows[vec_id].cast("long").alias("id"), rows[label].cast("long").alias("label"),
                        rows[vector].cast("array<double>").alias("vector"),
                        (F.lit(True) if anchor is None else F.coalesce(anchor, F.lit(False))).alias("anchor"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite)
    return known.withColumn("row", F.monotonically_increasing_id())


def _vectors(col) -> np.ndarray:
    """Rows of a list column as a matrix; shorter ones end in zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets).astype(np.int64)
    size, values = np.diff(off), col.values.to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(size), width))
    for w in np.unique(size[size > 0]).tolist():
        some = np.flatnonzero(size == w)
        out[some, :w] = values[off[some][:, None] + np.arange(w)]
    return out


def _written(rows: DataFrame, base: str, scale: float, file_rows: int) -> DataFrame:
    """Files of rows and of anchors: kind, path, number of rows."""
    def one(part: pa.Table, kind: str, name: str):
        own = {c: part.column(c).to_numpy() for c in ("id", "label", "row")}
        order = np.lexsort((own["row"], own["id"], own["label"]))  # equal scores are met by ascending id
        out = io.BytesIO()
        np.savez(out, vector=np.floor(scale * _vectors(part.column("vector")))[order], **{c: x[order] for c, x in own.items()})
        put(f"{base}/{kind}-{name}.npz", out.getvalue())
        return kind, f"{base}/{kind}-{name}.npz", part.num_rows

    def run(batches):
        task, nth, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            part = pa.Table.from_batches(held)
            made = [one(part, "rows", f"{task}-{nth}")]
            anchors = part.filter(part.column("anchor"))
            if anchors.num_rows:
                made.append(one(anchors, "anchors", f"{task}-{nth}"))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made)], schema=_FILES)

        for batch in batches:
            for at in range(0, batch.num_rows, file_rows):
                held.append(batch.slice(at, file_rows))
                n += held[-1].num_rows
                if n >= file_rows:
                    yield flush()
                    nth, held, n = nth + 1, [], 0
        if n:
            yield flush()

    return rows.mapInArrow(run, "kind string, path string, n long")


def _grouped(files: list, most: int) -> list[list[str]]:
    """Files in lots of at most ``most`` rows (one file at least)."""
    lots, n = [], 0
    for path, rows in files:
        if not lots or n + rows > most:
            lots.append([])
            n = 0
        lots[-1].append(path)
        n += rows
    return lots


def _dealt(files: list, groups: int) -> list[list[str]]:
    """Files dealt to at most ``groups`` lots of like size."""
    lots, n = [[] for _ in range(min(groups, len(files)))], np.zeros(min(groups, len(files)), np.int64)
    for path, rows in sorted(files, key=lambda f: (-f[1], f[0])):
        least = int(np.argmin(n))
        lots[least].append(path)
        n[least] += rows
    return lots


def _load(paths: list[str]) -> dict[str, np.ndarray]:
    """All rows of some files, by label, id and row."""
    got = []
    for path in paths:
        with arrays_of(path) as f:
            got.append({c: f[c] for c in ("vector", "id", "label", "row")})
    width = max(g["vector"].shape[1] for g in got)
    for g in got:
        g["vector"] = np.pad(g["vector"], ((0, 0), (0, width - g["vector"].shape[1])))
    out = {c: np.concatenate([g[c] for g in got]) for c in got[0]}
    order = np.lexsort((out["row"], out["id"], out["label"]))
    return {c: x[order] for c, x in out.items()}


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all of ``b``."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if most < 2 ** 53:
        return a @ b.T
    if most >= 2 ** 62:
        raise ValueError("components are too large for a 64-bit inner product")
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _first(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` greatest allowed scores of every row; of equal ones the first columns."""
    rows = np.flatnonzero(ok.any(axis=1))
    score, ok = score[rows], ok[rows]
    if score.shape[1] > k:
        least = score.dtype.type(-np.inf) if score.dtype.kind == "f" else np.iinfo(score.dtype).min
        value = np.where(ok, score, least)
        edge = np.partition(value, value.shape[1] - k, axis=1)[:, -k][:, None]
        above = value > edge
        ties = ok & (value == edge)
        ok = above | (ties & (np.cumsum(ties, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    i, j = np.nonzero(ok)
    return rows[i], j


def _trimmed(found: list[tuple], keys: int, k: int) -> tuple:
    """The first ``k`` by (descending score, id, row) of every key; a tuple is ``keys`` key columns, score, id, row."""
    cols = [np.concatenate(x) for x in zip(*found)]
    order = np.lexsort((cols[-1], cols[-2], -cols[-3], *cols[:keys][::-1]))
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols[:keys]:
        new[1:] |= c[1:] != c[:-1]
    nth = np.arange(len(order))
    keep = nth - np.maximum.accumulate(np.where(new, nth, 0)) < k
    return tuple(c[keep] for c in cols)


def _positives(a: dict, files: list[str], k: int, chunk: int) -> tuple:
    """(anchor's place, score, id, row) of every anchor's best rows of its label in ``files``."""
    found = []
    for path in files:
        with arrays_of(path) as f:
            r = {c: f[c] for c in ("vector", "id", "label", "row")}
        for label in np.intersect1d(a["label"], r["label"]).tolist():
            al, ar = (np.searchsorted(a["label"], label, side=s) for s in ("left", "right"))
            for lo in range(*(int(np.searchsorted(r["label"], label, side=s)) for s in ("left", "right")), chunk):
                hi = min(lo + chunk, int(np.searchsorted(r["label"], label, side="right")))
                score = scores_of(a["vector"][al:ar], r["vector"][lo:hi])
                i, j = _first(score, a["row"][al:ar, None] != r["row"][None, lo:hi], k)
                found.append((i + al, score[i, j].astype(np.int64), r["id"][lo:hi][j], r["row"][lo:hi][j]))
        if found:
            found = [_trimmed(found, 1, k)]
    return found[0] if found else (np.zeros(0, np.int64),) * 4


def _candidates(a: dict, files: list[str], low: np.ndarray, high: np.ndarray, k: int, chunk: int) -> tuple:
    """(anchor's place, window, score, id, row): every window's first rows of other labels in ``files``."""
    found, need = [], low.copy()
    for path in files:
        with arrays_of(path) as f:
            r = {c: f[c] for c in ("vector", "id", "label", "row")}
        order = np.lexsort((r["row"], r["id"]))
        r = {c: x[order] for c, x in r.items()}
        for at in range(0, len(r["id"]), chunk):
            some = slice(at, at + chunk)
            score = scores_of(a["vector"], r["vector"][some])
            other = a["label"][:, None] != r["label"][None, some]
            for w in range(low.shape[1]):
                ok = (score >= need[:, w, None]) & (score <= high[:, w, None]) & other
                i, j = _first(score, ok, k)
                if len(i):
                    found.append((i, np.full(len(i), w), score[i, j].astype(np.int64), r["id"][some][j], r["row"][some][j]))
            if found:
                best = _trimmed(found, 2, k)
                found = [best]
                # A full window takes no less than its last score.
                last = np.flatnonzero(np.append((best[0][1:] != best[0][:-1]) | (best[1][1:] != best[1][:-1]), True))
                size = np.diff(last, prepend=-1)
                full = last[size == k]
                need[best[0][full], best[1][full]] = np.maximum(need[best[0][full], best[1][full]], best[2][full])
    return found[0] if found else (np.zeros(0, np.int64),) * 5


def _packed(anchor, anchor_id, score, kind: int, ids, rows) -> pa.RecordBatch:
    """Keys that sort by anchor, descending score, positives before negatives, id and row."""
    out = np.empty(len(anchor), _KEY)
    for name, x in (("anchor", anchor), ("anchor_id", anchor_id), ("id", ids), ("row", rows)):
        out[name] = x.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    out["score"] = (-score.astype(np.int64)).view(np.uint64) ^ np.uint64(_SIGN)
    out["kind"] = kind
    raw = pa.py_buffer(out.tobytes())
    off = pa.py_buffer((np.arange(len(out) + 1) * _KEY.itemsize).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(out), [None, off, raw])], schema=_KEYS)


def windows(keys: Iterator[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Negatives of each positive from ascending packed keys, one anchor's open windows at a time."""
    now, opened = None, []
    for key in keys:
        anchor, anchor_id, score, kind, own, _ = _UNPACK(key)
        if anchor != now:
            now, opened = anchor, []
        score, own = _SIGN - score, own - _SIGN
        if kind == 0:
            opened.append([own, score, 0])
            continue
        for window in opened:
            positive, best, n = window
            if n < negatives and low * best <= 100 * score <= high * best:
                window[2] = n + 1
                yield anchor_id - _SIGN, positive, n + 1, own, best, score


def _dealer(key: bytes) -> int:
    """Partition number of a packed key: by its anchor alone."""
    return (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 33


def mine(spark: SparkSession, rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256.0, row_groups: int = 8, anchor_block: int = 2048, file_rows: int = 16384, chunk: int = 2048) -> DataFrame:
    """Hard negatives of the anchors among ``usable`` rows.

    ``low`` and ``high`` bound a negative's score in hundredths of its positive's.  A block of anchors and a
    chunk of rows bound a task's memory; the driver holds one entry per file.
    """
    base = scratch_path(spark, "llm-vectors")
    files = stored(spark, _written(rows, base, scale, file_rows), "vector-files").collect()
    blocks = _grouped(sorted((f.path, f.n) for f in files if f.kind == "anchors"), anchor_block)
    groups = _dealt([(f.path, f.n) for f in files if f.kind == "rows"], row_groups)
    n_groups, n_tasks = len(groups), len(blocks) * len(groups)
    if not n_tasks:
        return spark.createDataFrame([], OUT)
    grid = spark.range(0, n_tasks, 1, n_tasks)

    def nearest(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                a = _load(blocks[task // n_groups])
                at, score, ids, place = _positives(a, groups[task % n_groups], positives, chunk)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), task // n_groups)), pa.array(a["row"][at]), pa.array(score),
                                                  pa.array(ids), pa.array(place)], schema=_BEST)

    def settled(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        block = key[0].as_py()
        a = _load(blocks[block])
        by_row = np.argsort(a["row"])
        at = by_row[np.searchsorted(a["row"][by_row], part.column("anchor").to_numpy())]
        at, score, ids, place = _trimmed([(at, *(part.column(c).to_numpy() for c in ("score", "id", "row")))], 1, positives)
        out = io.BytesIO()
        np.savez(out, at=at, score=score)
        put(f"{base}/positives-{block}.npz", out.getvalue())
        return pa.table([np.full(len(at), block), _packed(a["row"][at], a["id"][at], score, 0, ids, place).column(0)], names=["block", "key"])

    def reached(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                block = task // n_groups
                if block not in known:
                    continue
                a = _load(blocks[block])
                with arrays_of(f"{base}/positives-{block}.npz") as f:
                    at, best = f["at"], f["score"]
                nth = np.arange(len(at)) - np.searchsorted(at, at)
                # Bounds that nothing meets where an anchor has fewer positives.
                lows, highs = np.ones((len(a["id"]), positives), np.int64), np.zeros((len(a["id"]), positives), np.int64)
                whole, rest = best // 100, best % 100  # apart, as low * best may be beyond 64 bits
                lows[at, nth], highs[at, nth] = low * whole - (-low * rest // 100), high * whole + high * rest // 100
                own, _, score, ids, place = _candidates(a, groups[task % n_groups], lows, highs, negatives, chunk)
                both = np.unique(np.stack([own, score, ids, place], axis=1), axis=0)  # windows share candidates
                own, score, ids, place = both.T
                yield _packed(a["row"][own], a["id"][own], score, 1, ids, place)

    found = grid.mapInArrow(nearest, "block long, anchor long, score long, id long, row long")
    opened = stored(spark, found.groupBy("block").applyInArrow(settled, "block long, key binary"), "positive-keys")
    known = {r.block for r in opened.select("block").distinct().collect()}
    keys = opened.select("key").unionByName(grid.mapInArrow(reached, "key binary"))
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(n_parts, _dealer)
    mined = ordered.mapPartitions(lambda part: windows((k for k, _ in part), negatives, low, high))
    return spark.createDataFrame(mined, OUT, verifySchema=False)


def contract_rows(table: DataFrame) -> DataFrame:
    """The contract's input: every seventh row has another label, every fiftieth is an anchor."""
    own = F.col("vec_id")
    label = F.when(own % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return usable(table.select("vec_id", label.alias("label"), "embedding"), anchor=own % 50 == 0)
