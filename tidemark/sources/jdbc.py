"""Relational table scan over JDBC (dimension snapshots).

``spark.read.jdbc`` with a numeric partition column splits the scan into
``num_partitions`` range queries run by the executors in parallel; column
selection and filters applied on the returned DataFrame are pushed into
the SQL sent to the database.  Without bounds the scan is one query.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if extra:
        opts.update(extra)
    return opts


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
               **kw) -> DataFrame:
    """Scan ``table``; with a partition column and bounds, in parallel ranges."""
    reader = spark.read.format("jdbc")
    for k, v in jdbc_options(url, table, **kw).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("partitioned JDBC scans need lower and upper bounds")
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower))
                        .option("upperBound", str(upper))
                        .option("numPartitions", str(num_partitions)))
    return reader.load()


def keyed_scan(spark: SparkSession, url: str, table: str, key: str = "id", num_partitions: int = 8,
               **kw) -> DataFrame:
    """Scan ``table`` in parallel ranges of its numeric ``key``; the database gives the ends of the key.

    An empty table is scanned by one query.  Rows outside the ends (written
    meanwhile, or without a key) fall to the first and last range.
    """
    ends = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) ends"
    lo, hi = jdbc_table(spark, url, ends, **kw).first()
    if lo is None:
        return jdbc_table(spark, url, table, **kw)
    return jdbc_table(spark, url, table, key, int(lo), int(hi), num_partitions, **kw)
