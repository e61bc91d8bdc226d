"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

Features are the n-grams, up to ``ngrams`` words, of a text's words and
of its word shapes (letter runs folded to one letter per case, digit
runs to one digit, signs kept), hashed to ``2 ** bits`` weights.  A
feature's value is its share of the text's n-grams times ``SCALE``, so
that a text's length does not matter.  The score is the logistic of the
sparse dot product.

Training takes a bounded sample (``max_train_rows``) of the labelled
rows, drawn by a hash of doc_id, and runs in one task; scoring runs over
all rows.  The model is ``2 ** bits`` floats whatever the input, which is
what every task is sent.

Defined results: a null or blank text has no features and the score of
the bias alone; labels without doc_id or quality are left out; a doc_id
that is labelled twice trains twice; without any label every score is
0.5; rows of documents are scored each; no rows give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .common import documents_of, share_of

SCALE = 32.0
_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

# Byte classes of a word's shape.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = _SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_FOLDED = np.zeros(256, bool)
_FOLDED[[ord("a"), ord("A"), ord("0")]] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bits: int
    ngrams: int


def _shapes(data, starts, ends) -> np.ndarray:
    """Hash of every word's shape."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    kind = _SHAPE[data]
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != kind[:-1]) | ~_FOLDED[kind[1:]]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    return T.span_hashes(kind[keep], place[starts], place[ends])


def features(col, bits: int, ngrams: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of a string column, and the row of each."""
    data, off = T.utf8(col)
    starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT)
    rows = T.row_of(words)
    found, of = [], []
    for kind, h in enumerate((T.span_hashes(data, starts, ends), _shapes(data, starts, ends))):
        for n in range(1, ngrams + 1):
            at = T.row_windows(rows, n)
            g = T.mix(T.rolling(h, n)[at] + np.uint64(2 * n + kind))
            found.append((g >> np.uint64(64 - bits)).astype(np.int64))
            of.append(rows[at])
    return np.concatenate(found), np.concatenate(of)


def scores(col, model: Model) -> np.ndarray:
    idx, row = features(col, model.bits, model.ngrams)
    n = np.bincount(row, minlength=len(col))
    total = np.bincount(row, model.weights[idx], minlength=len(col))
    return 1 / (1 + np.exp(-(model.weights[-1] + total * SCALE / np.maximum(n, 1))))


def train(col, labels: np.ndarray, bits: int, ngrams: int, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.1) -> Model:
    """Follow-the-regularised-leader with per-coordinate rates, one row after another."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for part in T.slices(pa.table({"t": col}), "t"):
        idx, row = features(part.column(0), bits, ngrams)
        order = np.argsort(row, kind="stable")
        idx, cuts = idx[order], np.searchsorted(row[order], np.arange(part.num_rows + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own, times = np.unique(idx[a:b], return_counts=True)
            rows.append((np.append(own, size).astype(np.int32),
                         np.append(times * (SCALE / max(1, b - a)), 1.0).astype(np.float32)))

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels):
            zi, ni = z[i], n[i]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-(w @ x))) - y) * x
            grown = ni + g * g
            z[i] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[i] = grown
    return Model(weights(z, n), bits, ngrams)


def held_out(doc_id="doc_id"):
    """Rows that no training sees: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, label, rank of about ``max_rows`` labelled rows at most, drawn by a hash of doc_id; never held-out ones."""
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    rows = rows.withColumn("rank", F.xxhash64("doc_id", F.lit(label)))
    share = min(1.0, max_rows / max(1, rows.count()))
    return rows if share == 1.0 else rows.filter(share_of(F.col("rank"), share))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", max_train_rows: int = 12_000,
        bits: int = 18, ngrams: int = 2) -> Model:
    """Train on a bounded sample of labelled rows, in one task."""
    # At most about max_train_rows small rows: their size is bounded by that parameter.
    chosen = F.broadcast(labelled_sample(labels, label, max_train_rows))
    # A doc_id that rows or labels repeat counts once, so the bound holds for the texts too.
    sample = documents_of(docs).join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("rank", "label", "text")).alias("s")) \
        .select(F.lit(0).alias("one"), "s.rank", "doc_id", "s.text", "s.label")

    def one(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.set_column(3, "text", part.column("text").fill_null("")) \
            .sort_by([("rank", "ascending"), ("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
        w = train(part.column("text").combine_chunks(), part.column("label").to_numpy(), bits, ngrams).weights
        return pa.table({"weights": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    got = sample.groupBy("one").applyInArrow(one, "weights binary").collect()
    if not got:
        return Model(np.zeros((1 << bits) + 1, np.float32), bits, ngrams)
    return Model(np.frombuffer(got[0].weights, np.float32), bits, ngrams)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted of every row."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(part.column(1), shared.value))], schema=_OUT)

    return documents_of(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, unchanged."""
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield part.filter(pa.array(scores(part.column(at), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
