"""Maintained dimension store: the latest image of every key, in partitions by key.

``compact`` runs a file stream over the changelog.  Its checkpoint is the
memory of what has been taken; its sink, ``arrivals``, holds the new images
by run and bucket (a hash of the key).  ``images`` holds one row per
``(dim_table, pk)`` by bucket, each bucket with the run it is merged up to.
A merge reads and rewrites only the buckets that newer arrivals touch, by
dynamic partition overwrite; all others keep their files.

A run that fails is made up for by the next: arrivals newer than their
bucket are merged whenever they came, and merging one twice changes
nothing, as the image with the greatest position wins.  Deleted keys stay
as images of type DELETE, so that an older image arriving late cannot
bring them back.  One writer at a time; ``arrivals`` of merged runs may be
expired like any log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..sources.streams import file_stream
from . import exists, overwrite_partitions

BUCKETS = 32


def _images(spark: SparkSession, store: str) -> DataFrame | None:
    path = f"{store}/images"
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).withColumn("bucket", F.col("bucket").cast("int"))


def _take(spark: SparkSession, log_path: str, store: str, pick: Callable[[DataFrame], DataFrame], run: int, buckets: int) -> DataFrame:
    """Run the stream over the changelog's new files; all arrivals so far."""
    log = pick(file_stream(spark, log_path, spark.read.parquet(log_path).schema))
    bucket = F.pmod(F.xxhash64("dim_table", "pk"), F.lit(buckets)).cast("int")
    fresh = log.withColumn("bucket", bucket).withColumn("run", F.lit(run).cast("long"))
    query = (fresh.writeStream.format("parquet").outputMode("append").partitionBy("run", "bucket")
             .option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start(f"{store}/arrivals"))
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(fresh.schema).parquet(f"{store}/arrivals")


def compact(spark: SparkSession, log_path: str, store: str, order: Sequence[str] = ("seq", "pos"),
            pick: Callable[[DataFrame], DataFrame] = lambda log: log, buckets: int = BUCKETS) -> list[int]:
    """Merge the changelog's new files into the store; returns the buckets rewritten.

    ``pick`` selects the changelog rows where the folder holds others too
    (``cdc.dim_log_of`` for the one-pass router's output).  ``buckets`` is
    fixed by the store's first run.
    """
    stored = _images(spark, store)
    # One entry per bucket: how far it is merged.
    upto = {} if stored is None else {r.bucket: r.run for r in stored.groupBy("bucket").agg(F.max("merged_run").alias("run")).collect()}
    run = max(upto.values(), default=0) + 1
    new = _take(spark, log_path, store, pick, run, buckets)
    if upto:  # on partition columns alone: folders that are merged are not listed for reading
        known = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])
        new = new.where(F.col("run") > F.coalesce(known[F.col("bucket")], F.lit(0)))
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
    if not touched:
        return []
    columns = ["dim_table", "pk", *order, "dim_key", "type", "value", "bucket"]
    changes = new.select(*columns)
    if stored is not None:
        changes = stored.where(F.col("bucket").isin(touched)).select(*columns).unionByName(changes)
    latest = cdc.dim_latest(changes, order, keep=("bucket",)).withColumn("merged_run", F.lit(run).cast("long"))
    overwrite_partitions(latest, f"{store}/images", "bucket")
    return touched


def read_images(spark: SparkSession, store: str, deletes: str = "keep") -> DataFrame:
    """The latest images; ``deletes="apply"`` leaves deleted keys out."""
    images = _images(spark, store)
    if images is None:
        raise FileNotFoundError(f"no images in {store}")
    images = images.drop("bucket", "merged_run")
    return images.where(F.col("type") != cdc.OP_DELETE) if deletes == "apply" else images
