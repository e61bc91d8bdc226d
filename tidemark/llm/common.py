"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

import io
import math
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table

__all__ = ["documents_of", "group_of", "pieces", "free_name", "numbered", "read_table", "scratch_path", "share_of", "stored", "string_array",
           "arrays_of", "by_bucket", "single_thread"]


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text``: extra columns can't clash with the operators' own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def pieces(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    """How many pieces of about ``bytes_each`` the input makes: it grows with the input.

    The size of stored tables is the plan's estimate; a plan that knows none
    (rows made in memory, joins) is measured by one aggregate.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, min(math.ceil(size / bytes_each), 1 << 30))


def share_of(number, share: float):
    """Rows whose 64-bit hash ``number`` falls in ``share`` of its range; fine enough for shares of a billionth."""
    return F.pmod(number, F.lit(1 << 40)) < F.lit(math.ceil(share * (1 << 40)))


def group_of(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n))


def stored(spark: SparkSession, df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, longer by underscores until no column has it (Spark tells columns apart without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and the number's column: rows are told apart whatever their doc_id.

    A table read from files is numbered by file and place in it, the same in
    every scan (31 bits of a hash of the file's name, salted until no two
    files share them); any other frame is stored with its numbers.
    """
    name = free_name(docs.columns, "row_number")
    if "_metadata" not in docs.columns and docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        path = F.col("_metadata.file_path")
        for salt in range(16):
            code = F.xxhash64(path, F.lit(salt)).bitwiseAND(0x7FFFFFFF)
            if len(set(docs.agg(F.countDistinct(path), F.countDistinct(code)).first())) == 1:
                return docs.withColumn(name, F.shiftleft(code, 32) + F.col("_metadata.row_index")), name
    return stored(spark, docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def arrays_of(path: str):
    """Arrays of an ``npz`` file in a shared folder."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(path)
        with store.open_input_file(path) as f:
            return np.load(io.BytesIO(f.read()))
    return np.load(re.sub(r"^file:(//)?", "", path))


def string_array(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """Arrow strings from UTF-8 bytes and row offsets (under 2 GB)."""
    return pa.Array.from_buffers(pa.string(), len(off) - 1,
                                 [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) runs of ascending 64-bit hashes, cut by their leading bits."""
    if not len(keys):
        return []
    b = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
    return [(int(b[s]), int(s), int(e)) for s, e in zip(cuts[:-1], cuts[1:])]


def single_thread() -> None:
    """Native libraries inside a task use that task's core only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
