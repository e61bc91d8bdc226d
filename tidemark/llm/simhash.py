"""SimHash near-dedup with pigeonhole blocks.

A fingerprint is cut in ``max_bits + 3`` blocks; two fingerprints that
differ in at most ``max_bits`` bits agree on some three of them.  Every
distinct fingerprint is dealt once to each choice of three blocks, those
that agree there meet, and their Hamming distance is verified.  Equal
fingerprints are folded first, so a group of copies counts once, and a
meeting place sends on a spanning forest, never its pairs.  Components
over the forests' edges give the groups.

Meeting places of many different fingerprints are not compared pair by
pair: past ``PAIRWISE`` of them, neighbours are probed by flipping the
bits that vary there, which is linear in their number.

Defined results: a null or blank text has no shingle and fingerprint
zero, linked like any other; a text shorter than the shingle is one
shingle; rows that repeat a doc_id are linked by their texts alone; a group
whose rows have no doc_id has no component_id; no rows give no rows;
extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .common import documents_of, numbered, pieces, stored
from .components import components

SEED = 42
PAIRWISE = 8192
_BITS = 1 << 15  # shingles whose bits are counted at a time
_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the word shingles of ``text``, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    count = np.zeros(64, np.int64)
    for i in range(0, n, _BITS):
        h = np.array([xxh64_intdigest(joined[s:e], SEED)
                      for s, e in zip(starts[i:i + _BITS].tolist(), stops[i:i + _BITS].tolist())], dtype="<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed 64-bit) of every row."""
    def make(batches):
        for batch in batches:
            for part in T.slices(batch, "text"):
                texts = part.column(1).fill_null("").cast(pa.binary()).to_pylist()
                fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], schema=_FP)

    return documents_of(docs).mapInArrow(make, "doc_id long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Masks of all choices of three of ``max_bits + 3`` blocks (signed 64-bit)."""
    n = max_bits + 3
    cuts = [64 * i // n for i in range(n + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:])]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(block, 3)]


class _Sets:
    """Disjoint sets over 0..n-1, joined many pairs at a time; the label is the smallest member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (self.of[self.of] != self.of).any():
                self.of = self.of[self.of]


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= max_bits


def _probe(fp: np.ndarray, own: np.ndarray, sets: _Sets, max_bits: int) -> None:
    """Join all of ``fp`` (numbers ``own``) that differ in at most ``max_bits`` bits, by flipping varying bits."""
    varies = np.bitwise_or.reduce(fp ^ fp[0])
    bits = [np.uint64(1 << i) for i in range(64) if int(varies) >> i & 1]

    def flips(most):
        return [np.bitwise_or.reduce(np.array(c, np.uint64)) if c else np.uint64(0)
                for k in range(most + 1) for c in combinations(bits, k)]

    few = flips(max_bits // 2)
    keys = np.concatenate([fp ^ m for m in few])
    who = np.tile(own, len(few))
    order = np.argsort(keys, kind="stable")
    keys, who = keys[order], who[order]
    same = np.flatnonzero(keys[1:] == keys[:-1])
    sets.join(who[same], who[same + 1])  # both are at most 2 * (max_bits // 2) bits apart
    for m in flips(max_bits - max_bits // 2):
        at = np.minimum(np.searchsorted(keys, fp ^ m), len(keys) - 1)
        hit = keys[at] == fp ^ m
        sets.join(own[hit], who[at[hit]])


def linked(place: np.ndarray, key: np.ndarray, fp: np.ndarray, max_bits: int,
           pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (fingerprint, smallest of its set) among fingerprints that share place and key."""
    order = np.lexsort((fp, key, place))
    place, key, fp = place[order], key[order], fp[order]
    new = np.ones(len(fp), bool)
    new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
    edge = np.append(np.flatnonzero(new), len(fp))
    size = np.diff(edge)
    keep = np.repeat(size > 1, size)
    run = np.repeat(np.arange(len(size)), size)[keep]
    fp, size = fp[keep], size[size > 1]
    names, own = np.unique(fp, return_inverse=True)
    sets, wide = _Sets(len(names)), fp.view(np.uint64)
    small = np.repeat(size <= 64, size)
    i = np.flatnonzero(small)
    for d in range(1, 64):
        i = i[i + d < len(fp)]
        i = i[run[i + d] == run[i]]
        if not len(i):
            break
        hit = i[_near(wide[i], wide[i + d], max_bits)]
        sets.join(own[hit], own[hit + d])
    edge = np.concatenate([[0], np.cumsum(size)])
    for s, e in zip(edge[:-1][size > 64], edge[1:][size > 64]):
        if e - s > pairwise:
            _probe(wide[s:e], own[s:e], sets, max_bits)
            continue
        for at in range(s, e, 256):
            x, y = np.nonzero(_near(wide[at:min(at + 256, e), None], wide[None, at:e], max_bits))
            sets.join(own[at + x], own[at + y])
    moved = np.flatnonzero(sets.of != np.arange(len(names)))
    return names[moved], names[sets.of[moved]]


def fingerprint_links(fps: DataFrame, max_bits: int = 3, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Edges (a, b) that connect all fingerprints which differ in at most ``max_bits`` bits."""
    masks = block_masks(max_bits)
    n = pieces(fps, max(1, bucket_bytes // (3 * len(masks))))
    dealt = fps.select("fp").distinct().select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("place"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("at")).select("at.place", "at.key", "fp")

    def meet(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        a, b = linked(*(part.column(c).to_numpy() for c in ("place", "key", "fp")), max_bits)
        return pa.table([a, b], schema=_EDGE)

    return dealt.withColumn("bucket", F.pmod(F.xxhash64("place", "key"), F.lit(n))) \
        .groupBy("bucket").applyInArrow(meet, "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) of every row."""
    fps = stored(spark, fingerprints(docs, shingle), "fingerprints")
    links = components(spark, fingerprint_links(fps, max_bits))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    rooted = least.join(links.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    return fps.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp") \
        .select("doc_id", "fp", "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each group: the one with the smallest doc_id, of equal ones the first; rows without doc_id come last.

    Rows are told apart by a number of their own, so that repeated and missing doc_ids lose no group.
    """
    rows, row = numbered(spark, docs)
    groups = near_duplicates(spark, rows.select(F.col(row).alias("doc_id"), "text"), shingle, max_bits)
    ids = rows.select(F.col(row).alias("doc_id"), rows["doc_id"].cast("long").alias("id"))
    first = groups.join(ids, "doc_id").groupBy("component_id") \
        .agg(F.min(F.struct(F.col("id").isNull(), "id", F.col("doc_id").alias("row"))).alias("first"))
    stay = first.select(F.col("first.row").alias("stays"))
    return rows.join(stay, rows[row] == stay["stays"], "left_semi").select(*docs.columns)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op7``."""
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
