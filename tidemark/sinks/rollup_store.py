"""Aggregates maintained from changes: signed deltas merged into stored sums.

The store holds, per bucket (a hash of the row key), the last image of each
key and the bucket's own sums per grouping value.  A batch of changes is
cut to the last one per key and held against the stored images: a new
image adds its values, a replaced or deleted one takes its old values off.
Only buckets with changes are read and rewritten, images and sums of a
bucket in one partition folder by one overwrite, so they stay in step: a
change that is merged again, or one older than the stored image, gives no
delta.  Reading adds up the buckets' sums, which are as many as buckets
times grouping values, however many rows lie below.

Amounts are decimals, so that what is taken off is exactly what was added.
Deleted keys stay as images without values, so that an older change that
comes late cannot revive them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import OP_DELETE
from ..session import scratch_path
from . import exists, overwrite_partitions

AMOUNT = "decimal(38,4)"
BUCKETS = 32
IMAGE, SUM = 0, 1


def _schema(groupings: Sequence[str], key_type: str) -> str:
    own = "".join(f"`{g}` string, " for g in groupings)
    return f"kind int, row_key {key_type}, seq long, type string, {own}grouping string, value string, n long, amount {AMOUNT}, bucket int"


def _state(spark: SparkSession, path: str, groupings: Sequence[str], key_type: str) -> DataFrame:
    schema = _schema(groupings, key_type)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _deltas(groupings: Sequence[str], source: str, sign: int, there) -> list:
    """One delta per grouping for the image in ``source``, where it is ``there``."""
    return [F.when(there, F.struct(F.lit(g).alias("grouping"), F.col(f"{source}.{g}").alias("value"), F.lit(sign).cast("long").alias("n"),
                                   (F.col(f"{source}.amount") * sign).cast(AMOUNT).alias("amount"))) for g in groupings]


def merge(changes: DataFrame, path: str, groupings: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Merge ``changes`` (row_key, seq, type, amount and one text column per grouping); returns the buckets rewritten.

    ``seq`` orders the changes of a key.  ``groupings`` and ``buckets`` are fixed by the store's first batch.
    """
    spark = changes.sparkSession
    fields = ["seq", "type", *groupings, "amount"]
    own = changes.select("row_key", F.col("seq").cast("long").alias("seq"), "type", *[F.col(g).cast("string").alias(g) for g in groupings],
                         F.col("amount").cast(AMOUNT).alias("amount")).where("row_key is not null and seq is not null")
    last = own.groupBy("row_key").agg(F.max(F.struct(*fields)).alias("new"))
    staged = scratch_path(spark, "rollup-batch")
    last.withColumn("bucket", F.pmod(F.xxhash64("row_key"), F.lit(buckets)).cast("int")) \
        .write.mode("overwrite").partitionBy("bucket").parquet(staged)
    last = spark.read.schema(last.withColumn("bucket", F.lit(0)).schema).parquet(staged)
    touched = sorted(r.bucket for r in last.select("bucket").distinct().collect())
    if not touched:
        return []
    key_type = dict(last.dtypes)["row_key"]
    stored = _state(spark, path, groupings, key_type).where(F.col("bucket").isin(touched))
    images = stored.where(F.col("kind") == IMAGE).select("bucket", "row_key", F.struct(*fields).alias("old"))
    both = last.join(images, ["bucket", "row_key"], "full_outer")
    newer = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new.seq") > F.col("old.seq")))
    deltas = F.array(*_deltas(groupings, "new", 1, newer & ~F.col("new.type").eqNullSafe(OP_DELETE)),
                     *_deltas(groupings, "old", -1, newer & F.col("old").isNotNull() & ~F.col("old.type").eqNullSafe(OP_DELETE)))
    settled = scratch_path(spark, "rollup-settled")
    both = both.select("bucket", "row_key", F.when(newer, F.col("new")).otherwise(F.col("old")).alias("image"),
                       F.filter(deltas, lambda d: d.isNotNull()).alias("deltas"))
    both.write.mode("overwrite").parquet(settled)
    both = spark.read.schema(both.schema).parquet(settled)
    none = [F.lit(None).cast("string").alias(c) for c in ("grouping", "value")]
    rows = both.select(F.lit(IMAGE).alias("kind"), "row_key", "image.seq", "image.type", *[f"image.{g}" for g in groupings], *none,
                       F.lit(None).cast("long").alias("n"), "image.amount", "bucket")
    change = both.where(F.size("deltas") > 0).select("bucket", F.inline("deltas"))
    before = stored.where(F.col("kind") == SUM).select("bucket", "grouping", "value", "n", "amount")
    sums = before.unionByName(change).groupBy("bucket", "grouping", "value") \
                 .agg(F.sum("n").alias("n"), F.sum("amount").cast(AMOUNT).alias("amount")).where("n <> 0")
    sums = sums.select(F.lit(SUM).alias("kind"), F.lit(None).cast(key_type).alias("row_key"), F.lit(None).cast("long").alias("seq"),
                       *[F.lit(None).cast("string").alias(c) for c in ("type", *groupings)], "grouping", "value", "n", "amount", "bucket")
    # Sums first within a file, so that readers of sums skip the row groups of images.
    overwrite_partitions(rows.unionByName(sums), path, "bucket", F.desc("kind"))
    return touched


def read(spark: SparkSession, path: str, groupings: Sequence[str], key_type: str = "long") -> DataFrame:
    """``grouping, value, n, amount`` over all buckets."""
    sums = _state(spark, path, groupings, key_type).where(F.col("kind") == SUM)
    total = sums.groupBy("grouping", "value").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    return total.where("n <> 0")


def recomputed(rows: DataFrame, groupings: Sequence[str]) -> DataFrame:
    """The same answer from the rows themselves."""
    parts = [rows.groupBy(F.col(g).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast(AMOUNT)).alias("amount"))
             .select(F.lit(g).alias("grouping"), "value", "n", "amount") for g in groupings]
    return reduce(DataFrame.unionByName, parts)
