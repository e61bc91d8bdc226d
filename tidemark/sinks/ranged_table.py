"""A table in ranges of a total order, for pages by position.

Rows are dealt to ranges by all columns (``repartitionByRange``), one
partition folder per range; a small table holds how many rows each range
has.  The number of ranges grows with the rows, so that a range stays a
bounded piece for the task that writes it and the pages that read it.  A page by position adds up the counts and reads only the ranges that
the page touches, so a deep page costs what the first one does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def order_of(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def write(df: DataFrame, path: str, ranges: int, range_rows: int = 1 << 20) -> None:
    """Write ``df`` in ``ranges`` ranges of about equal size, or more where they would be over ``range_rows``, ordered by all its columns.

    ``df`` is computed once, into the shared scratch folder: the count and the ranges' bounds come from there.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "ranged-rows")
    df.write.mode("overwrite").parquet(staged)
    df = spark.read.schema(df.schema).parquet(staged)
    ranges = max(ranges, -(-df.count() // range_rows))
    dealt = df.repartitionByRange(ranges, *order_of(df.columns)).withColumn("_range", F.spark_partition_id())
    dealt.write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    rows = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
    rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")


def total(spark: SparkSession, path: str) -> int:
    """Number of rows, from the counts alone."""
    return spark.read.parquet(f"{path}/counts").agg(F.sum("n")).first()[0] or 0


def page_at(spark: SparkSession, path: str, schema, start: int, length: int) -> DataFrame:
    """Rows ``start`` to ``start + length`` of the order; ``schema`` is the table's own.

    The counts on the driver are one number per range.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    rows = spark.read.schema(", ".join([*fields, "_range int"])).parquet(f"{path}/rows")
    before, skipped, wanted = 0, 0, []
    for r in sorted(spark.read.parquet(f"{path}/counts").collect(), key=lambda r: r["_range"]):
        if before + r.n <= start:
            skipped = before + r.n
        elif before < start + length:
            wanted.append(r["_range"])
        before += r.n
    page = rows.where(F.col("_range").isin(wanted)).drop("_range")
    return page.orderBy(*order_of(page.columns)).offset(max(0, start - skipped)).limit(length)
