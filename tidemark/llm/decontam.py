"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores the postings of every training token: documents
are cut into segments of a bounded size, and a segment's row holds its
rows, its distinct terms (64-bit hashes) and, per term, the ascending
positions.  Segments never share a document, so lists are intersected
where they lie and no posting is ever shuffled; a frequent word is
spread over all segments.

``phrase_spans`` looks phrases up: in each segment a phrase starts from
its rarest term there, and the lists of its other terms, shifted by
their offsets, are intersected from the next rarest on.
``proximity_hits`` asks for all terms of a phrase near its rarest one.
Phrases come in files of about ``BLOCK_WORDS`` words, which tasks write
and tasks read, one at a time: the benchmark never passes the driver, and
the index is read once for all of them.

Defined results: a null text has no words, an item without words no
window, an item without item_id is left out; rows of documents are
judged each, also when doc_id repeats or is null; an empty benchmark
hits nothing; no documents give no rows; extra columns are ignored.
"""

from __future__ import annotations

import io
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .common import arrays_of, documents_of, numbered, pieces, scratch_path, stored
from .token_store import put

BLOCK_WORDS = 1_000_000
_PARTS = ("ids", "known", "words", "terms", "first", "at")
INDEX = "seg long, " + ", ".join(f"{p} binary" for p in _PARTS)
_INDEX = pa.schema([("seg", pa.int64()), *((p, pa.binary()) for p in _PARTS)])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_HITS = pa.schema([("seg", pa.int64()), ("row", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.int64()))])


def words(col) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered, ASCII signs separate) and the rows' offsets."""
    data, off = T.utf8(col)
    data = T.LOWER[data]
    starts, ends, at = T.word_bounds(data, off, T.ALNUM_SPLIT)
    return T.span_hashes(data, starts, ends), at


def build_index(spark: SparkSession, docs: DataFrame, segment_bytes: int = 8 << 20) -> DataFrame:
    """Write the positional index of ``docs`` below the shared folder and return it."""
    def index(batches):
        seg = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in T.slices(batch, "text", segment_bytes):
                h, off = words(part.column(1))
                at = np.argsort(h, kind="stable")
                h = h[at]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                doc = part.column(0)
                row = [doc.fill_null(0).to_numpy(zero_copy_only=False),
                       doc.is_valid().to_numpy(zero_copy_only=False), off.astype(np.uint32), h[new],
                       np.append(np.flatnonzero(new), len(h)).astype(np.uint32), at.astype(np.uint32)]
                yield pa.RecordBatch.from_arrays([pa.array([seg]), *(pa.array([x.tobytes()], pa.binary()) for x in row)],
                                                 schema=_INDEX)
                seg += 1

    return stored(spark, documents_of(docs).mapInArrow(index, INDEX), "positions", compression="zstd")


class Segment:
    """One row of the index."""

    def __init__(self, raw: dict):
        kinds = (np.int64, bool, np.uint32, np.uint64, np.uint32, np.uint32)
        self.ids, self.known, self.words, self.terms, self.first, self.at = (
            np.frombuffer(raw[p], k) for p, k in zip(_PARTS, kinds))
        self.words, self.first = self.words.astype(np.int64), self.first.astype(np.int64)
        # Postings as one ascending list of (term, position).
        self.keys = (np.repeat(np.arange(len(self.terms)), np.diff(self.first)) << 32) | self.at

    def term(self, h: np.ndarray) -> np.ndarray:
        """Number of each term here, -1 if it has no postings."""
        if not len(self.terms):
            return np.full(h.shape, -1, np.int64)
        i = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[i] == h, i, -1)

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words, at, side="right") - 1

    def _rarest(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots from the rarest term on; every posting of the rarest, with its phrase."""
        n = self.first[t + 1] - self.first[t]
        order = np.argsort(n, axis=1, kind="stable")
        lead = t[np.arange(len(t)), order[:, 0]]
        size = self.first[lead + 1] - self.first[lead]
        total = np.concatenate([[0], np.cumsum(size)])
        at = self.at[np.repeat(self.first[lead] - total[:-1], size) + np.arange(total[-1])].astype(np.int64)
        return order, np.repeat(np.arange(len(t)), size), at

    def phrases(self, t: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence of the phrases of ``length`` words that begin at
        ``starts`` among words whose terms have the numbers ``t`` here."""
        unknown = np.concatenate([[0], np.cumsum(t < 0)])
        own = np.flatnonzero(unknown[starts + length] == unknown[starts])
        if not len(own):
            return own, own
        t = t[starts[own][:, None] + np.arange(length)]
        order, p, at = self._rarest(t)
        at = at - order[p, 0]
        for k in range(1, length):
            slot = order[p, k]
            key = (t[p, slot] << 32) | (at + slot)
            hit = (at >= 0) & (self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key)
            p, at = p[hit], at[hit]
        inside = (at >= 0) & (self.row(at) == self.row(at + length - 1))
        return own[p[inside]], at[inside]

    def near(self, terms: np.ndarray, reach: int) -> np.ndarray:
        """Places of the rarest of ``terms`` with all others at most ``reach`` words away in the row."""
        t = self.term(np.unique(terms))
        if not len(t) or (t < 0).any():
            return np.zeros(0, np.int64)
        order, _, at = self._rarest(t[None, :])
        for k in order[0, 1:]:
            row = self.row(at)
            low = np.maximum(at - reach, self.words[row])
            high = np.minimum(at + reach, self.words[row + 1] - 1)
            i = np.searchsorted(self.keys, (t[k] << 32) | low)
            at = at[(i < len(self.keys)) & (self.keys[np.minimum(i, len(self.keys) - 1)] <= ((t[k] << 32) | high))]
        return at


def windows_of(off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and item of every window; item i has the words ``off[i]`` to ``off[i + 1]``."""
    n = np.diff(off)
    size = np.minimum(n, window)
    windows = np.where(n > 0, n - size + 1, 0)
    item = np.repeat(np.arange(len(n)), windows)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    return off[:-1][item] + nth, size[item], item


def write_blocks(spark: SparkSession, items: DataFrame, window: int, block_words: int) -> list[str]:
    """Write the windows of ``items`` (item_id, text) in files of about ``block_words`` words; returns their paths.

    One item is never divided; a task's last file may be small.
    """
    items = items.filter("item_id is not null and text is not null")
    folder = scratch_path(spark, "phrases")

    def write(batches):
        nth = TaskContext.get().partitionId() << 32
        held, n = [], 0

        def block() -> pa.RecordBatch:
            at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(off) for _, off, _ in held]))])
            start, size, item = windows_of(at, window)
            content = io.BytesIO()
            np.savez(content, words=np.concatenate([h for h, _, _ in held]), start=start, size=size,
                     item=np.concatenate([ids for _, _, ids in held])[item])
            path = f"{folder}/block-{nth:016x}.npz"
            put(path, content.getvalue())
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in batches:
            for part in T.slices(batch, "text", 4 * block_words):
                held.append((*words(part.column(1)), part.column(0).to_numpy(zero_copy_only=False)))
                n += len(held[-1][0])
                if n >= block_words:
                    yield block()
                    held, n, nth = [], 0, nth + 1
        if n:
            yield block()

    few = items.coalesce(pieces(items, 6 * block_words))
    return sorted(r.path for r in few.mapInArrow(write, "path string").collect())  # a path per ``block_words`` words


@lru_cache(maxsize=1)
def _block(path: str) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """A file's words, and its windows (number of words, first words, items) by their number of words."""
    with arrays_of(path) as kept:
        h, start, size, item = (kept[k] for k in ("words", "start", "size", "item"))
    return h, [(int(n), start[size == n], item[size == n]) for n in np.unique(size)]


def phrase_spans(index: DataFrame, blocks: list[str]) -> DataFrame:
    """seg, row, spans (merged, in words of the row) and items of every row with an occurrence.

    ``blocks`` are files of phrases, as from ``write_blocks``.
    """
    def find(batches):
        for batch in batches:
            for raw in batch.to_pylist():
                seg = Segment(raw)
                starts, lengths, items = [], [], []
                for path in blocks:
                    h, windows = _block(path)
                    t = seg.term(h)
                    for length, first, item in windows:
                        p, at = seg.phrases(t, first, length)
                        starts.append(at)
                        lengths.append(np.full(len(at), length))
                        items.append(item[p])
                starts, lengths, items = (np.concatenate(x) if x else np.zeros(0, np.int64)
                                          for x in (starts, lengths, items))
                yield _rows_of(seg, raw["seg"], starts, lengths, items)

    return index.mapInArrow(find, "seg long, row long, spans array<struct<start:bigint,length:bigint>>, items array<long>")


def _rows_of(seg: Segment, number: int, starts, lengths, items) -> pa.RecordBatch:
    total = int(seg.words[-1])
    hit = T.covered(total, starts, lengths)
    # Runs of hit words, cut where a row ends.
    first, last = hit.copy(), hit.copy()
    first[1:] &= ~hit[:-1]
    last[:-1] &= ~hit[1:]
    edges = seg.words[1:-1]
    edges = edges[(edges > 0) & (edges < total)]
    first[edges] |= hit[edges]
    last[edges - 1] |= hit[edges - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    run_row, item_row = seg.row(s), seg.row(starts)
    rows = np.unique(run_row)
    pairs = np.unique(np.stack([item_row, items], axis=1), axis=0) if len(items) else np.zeros((0, 2), np.int64)
    spans = pa.ListArray.from_arrays(
        pa.array(np.append(np.searchsorted(run_row, rows), len(s)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(s - seg.words[run_row]), pa.array(e - s)], ["start", "length"]))
    lists = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(pairs[:, 0], rows), len(pairs)), pa.int32()),
                                     pa.array(pairs[:, 1]))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), number)), pa.array(rows), spans, lists], schema=_HITS)


def index_rows(index: DataFrame) -> DataFrame:
    """seg, row, doc_id, n_words of every document in the index."""
    schema = pa.schema([("seg", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())])

    def rows(batches):
        for batch in batches:
            for seg, ids, known, off in zip(*(c.to_pylist() for c in batch.columns)):
                doc = pa.array(np.frombuffer(ids, np.int64), mask=~np.frombuffer(known, bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), seg)), pa.array(np.arange(len(doc))), doc,
                     pa.array(np.diff(np.frombuffer(off, np.uint32).astype(np.int64)))], schema=schema)

    return index.select("seg", "ids", "known", "words").mapInArrow(rows, "seg long, row long, doc_id long, n_words long")


def proximity_hits(index: DataFrame, phrases: list[tuple[int, str]], slop: int) -> DataFrame:
    """phrase_id, doc_id, at: every place of a phrase's rarest term (in its segment) with all its other
    terms at most ``len(words) - 1 + slop`` words away in the same document.  ``phrases`` is a bounded list."""
    asked = [(i, words(pa.array([text]))[0]) for i, text in phrases]
    schema = pa.schema([("phrase_id", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])

    def find(batches):
        for batch in batches:
            for raw in batch.to_pylist():
                seg = Segment(raw)
                for i, h in asked:
                    at = seg.near(h, len(h) - 1 + slop)
                    row = seg.row(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), i)), pa.array(seg.ids[row], mask=~seg.known[row]),
                         pa.array(at - seg.words[row])], schema=schema)

    return index.mapInArrow(find, "phrase_id long, doc_id long, at long")


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 13,
                  segment_bytes: int = 8 << 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, items (benchmark items with occurring windows), spans of every document."""
    index = build_index(spark, docs, segment_bytes)
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"),
                             benchmark["text"].cast("string").alias("text"))
    hits = phrase_spans(index, write_blocks(spark, items, window, block_words))
    rows = index_rows(index)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return rows.join(hits, ["seg", "row"], "left").select(
        "doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,length:bigint>>")).alias("spans"))


def is_contaminated(share: int = 20):
    """At least one hit word, and at least one in ``share`` of all words."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged by itself whatever its doc_id."""
    rows, row = numbered(spark, docs)
    found = contamination(spark, rows.select(F.col(row).alias("doc_id"), "text"), benchmark, **options)
    gone = found.filter(is_contaminated()).select(F.col("doc_id").alias("goes"))
    return rows.join(gone, rows[row] == gone["goes"], "left_anti").select(*docs.columns)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op3``."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                         is_contaminated().alias("contaminated"))
