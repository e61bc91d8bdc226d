"""Token-ID output: binary shards of patched frame-of-reference blocks.

``write_tokens`` encodes every text, deals the ids to shards by doc_id
range (cut points are percentiles of doc_id over all rows) and writes
one file per shard (``pfor`` has the layout); shard numbers and rows
inside a shard ascend by doc_id.  A task writes to a name of its own and
renames it, so a repeated task leaves the same file.  ``read_tokens``
reads the files with Spark's binary reader.

Defined results: a null or empty text is the end id alone; rows without
doc_id come first; rows that repeat a doc_id are ordered by their ids;
no rows give no files and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pfor
from . import textops as T
from .common import documents_of, pieces
from .encode import default_path, encoder

_SENT = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])
_FILES = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def put(path: str, content: bytes) -> None:
    """Write a whole file under its final name only when it is complete."""
    part = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        from pyarrow import fs

        store, part = fs.FileSystem.from_uri(part)
        with store.open_output_stream(part) as f:
            f.write(content)
        store.move(part, fs.FileSystem.from_uri(path)[1])
        return
    path, part = (re.sub(r"^file:(//)?", "", p) for p in (path, part))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(part, "wb") as f:
        f.write(content)
    os.replace(part, path)


def _cut_points(docs: DataFrame, n: int) -> np.ndarray:
    """``n`` - 1 percentiles of doc_id over all rows (distributed sketch)."""
    if n < 2:
        return np.zeros(0, np.int64)
    at = [i / n for i in range(1, n)]
    got = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * n)).alias("q")).first().q
    return np.unique(np.array(got or [], np.int64))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
                 percentile: float = 0.9, shard_bytes: int = 8 << 20) -> list[tuple[int, int, int]]:
    """Write all documents below ``path``; returns (shard, documents, ids) of each file, ascending.

    ``shard_bytes`` is the input size of a shard, ``percentile`` the share of a
    block's ids that its width must hold.  The list is one small entry per file.
    """
    tokenizer = tokenizer or default_path()
    rows = documents_of(docs)
    cuts = _cut_points(rows, pieces(docs, shard_bytes))

    def encode(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for part in T.slices(batch, "text", 3 << 20):
                ids, off = enc.rows(part.column(1))
                end = np.array([end_id], enc.dtype).tobytes()
                raw, size = ids.tobytes(), ids.itemsize
                doc = part.column(0)
                shard = np.searchsorted(cuts, doc.fill_null(0).to_numpy(zero_copy_only=False), side="right")
                shard[~doc.is_valid().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), doc,
                     pa.array([raw[a * size:b * size] + end for a, b in zip(off[:-1], off[1:])], pa.binary())],
                    schema=_SENT)

    def write(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        kind = encoder(tokenizer).dtype
        doc = part.column("doc_id")
        known, raw = doc.is_valid().to_pylist(), part.column("ids").to_pylist()
        doc = doc.fill_null(0).to_pylist()
        order = sorted(range(len(raw)), key=lambda i: (known[i], doc[i], raw[i]))
        sizes = np.array([len(raw[i]) for i in order], np.int64) // np.dtype(kind).itemsize
        ids = np.frombuffer(b"".join([raw[i] for i in order]), kind)
        content = pfor.to_file(np.array([doc[i] for i in order], np.int64), known.count(False),
                               np.concatenate([[0], np.cumsum(sizes)]), ids, percentile)
        put(f"{path}/shard-{key[0].as_py():08d}.pfor", content)
        return pa.table([[key[0].as_py()], [len(order)], [len(ids)]], schema=_FILES)

    sent = rows.mapInArrow(encode, "shard int, doc_id long, ids binary")
    files = sent.groupBy("shard").applyInArrow(write, "shard int, n_docs long, n_ids long")
    return sorted(map(tuple, files.collect()))


def read_tokens(spark: SparkSession, path: str, files: list[tuple[int, int, int]], with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids (u32, little endian) of every row."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    if not files:
        return spark.createDataFrame([], schema)
    before = dict(zip((f[0] for f in files), np.concatenate([[0], np.cumsum([f[2] for f in files])]).tolist()))

    def decode(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc, n_null, starts, ids = pfor.from_file(content.as_py())
                first = before[int(re.search(r"shard-(\d+)\.pfor$", name)[1])]
                for i in range(0, len(doc), 5000):
                    at = starts[i:i + 5001]
                    raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]
                    own = pa.array(doc[i:i + 5000], mask=np.arange(i, i + len(raw)) < n_null)
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(at[:-1] + first), pa.array(np.diff(at)), pa.array([zlib.crc32(x) for x in raw]),
                         pa.array(raw if with_ids else [None] * len(raw), pa.binary())], schema=_ROWS)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(path)
    return found.select("path", "content").mapInArrow(decode, schema)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op6``."""
    return result.select("doc_id", "start", "n_tokens", "ids_crc32")
