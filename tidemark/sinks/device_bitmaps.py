"""Exact device sets per day as bitmaps, over a dictionary of devices.

Every device gets a number when it is first seen; a day is the bitmap of
its devices' numbers, in pieces of 32,768 bits (Spark's ``bitmap_*``
functions).  The union of days is an OR of pieces, so the devices active
in any range of days are counted exactly without reading a device id.
Merging a load again, or days in any order, changes nothing: known devices
keep their numbers and an OR absorbs what it holds already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import exists, overwrite_partitions

DEVICES = "mid string, id long"
PIECES = "piece long, bits binary, dt string"


def devices(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary: ``mid, id``."""
    if not exists(spark, f"{path}/devices"):
        return spark.createDataFrame([], DEVICES)
    return spark.read.schema(DEVICES).parquet(f"{path}/devices")


def _number_new(dau: DataFrame, path: str) -> DataFrame:
    """Add the load's unknown devices to the dictionary; the dictionary after that.

    A task numbers its new devices in a row, so that pieces are well filled.
    """
    spark = dau.sparkSession
    known = devices(spark, path)
    base = (known.agg(F.max("id")).first()[0] or -1) + 1
    new = dau.select("mid").where(F.col("mid").isNotNull()).distinct().join(known, "mid", "left_anti")
    staged = scratch_path(spark, "new-devices")
    new.withColumn("id", F.monotonically_increasing_id() + F.lit(base)).write.mode("overwrite").parquet(staged)
    spark.read.schema(DEVICES).parquet(staged).write.mode("append").parquet(f"{path}/devices")
    return devices(spark, path)


def merge(dau: DataFrame, path: str) -> None:
    """Merge device-days (``dt``, ``mid``) into the stored bitmaps; rewrites the load's days only."""
    spark = dau.sparkSession
    numbered = dau.select("dt", "mid").where(F.col("dt").isNotNull()).join(_number_new(dau, path), "mid")
    pieces = numbered.groupBy("dt", F.bitmap_bucket_number("id").alias("piece")) \
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    staged = scratch_path(spark, "day-bitmaps")
    pieces.select("piece", "bits", "dt").hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(staged)
    fresh = spark.read.schema(PIECES).parquet(staged)
    days = [r.dt for r in fresh.select("dt").distinct().collect()]  # one entry per calendar day
    if not days:
        return
    if exists(spark, f"{path}/days"):
        stored = spark.read.schema(PIECES).parquet(f"{path}/days").where(F.col("dt").isin(days))
        fresh = stored.unionByName(fresh).groupBy("dt", "piece").agg(F.bitmap_or_agg("bits").alias("bits")).select("piece", "bits", "dt")
    overwrite_partitions(fresh, f"{path}/days", "dt")


def active_over_days(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """One row: devices ``active`` from ``first`` to ``last``, and how many of them are ``new`` or ``returning``.

    A device is new when no earlier day has it.  ``first`` must not lie behind ``last``; later days are not read.
    """
    days = spark.read.schema(PIECES).parquet(f"{path}/days").where(F.col("dt") <= last)
    inside = F.col("dt").between(first, last)
    per_piece = days.groupBy("piece").agg(F.bitmap_or_agg(F.when(inside, F.col("bits"))).alias("inside"),
                                          F.bitmap_or_agg(F.when(F.col("dt") < first, F.col("bits"))).alias("before"),
                                          F.bitmap_or_agg("bits").alias("ever"))
    n = per_piece.agg(*[F.coalesce(F.sum(F.bitmap_count(c)), F.lit(0)).alias(c) for c in ("inside", "before", "ever")])
    new = F.col("ever") - F.col("before")
    return n.select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), F.col("inside").alias("active"),
                    (F.col("inside") - new).alias("returning"), new.alias("new"))
