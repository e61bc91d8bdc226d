"""Streaming sources for page logs and change records.

Production reads Kafka (``format="kafka"``, needs the Kafka connector on
the classpath); tests and replays read files that carry the same
``value`` column.  Resume position lives in the query's checkpoint: the
explicit per-partition ``offsets`` only matter on the very first start.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_COLUMNS = ("value", "topic", "partition", "offset", "timestamp")


def offsets_json(topic: str, offsets: Mapping[int, int]) -> str:
    """Per-partition start offsets (inclusive) in Kafka's ``startingOffsets`` form."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(offsets.items())}})


def kafka_options(topic: str, bootstrap: str, group_id: str | None = None,
                  offsets: Mapping[int, int] | None = None,
                  max_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of a Kafka subscription.

    No stored offsets -> start at ``latest`` (new data only); stored
    offsets -> start exactly there.  Offsets are tracked by the query's
    checkpoint, never auto-committed.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": offsets_json(topic, offsets) if offsets else "latest",
        "failOnDataLoss": "true",
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def log_stream(spark: SparkSession, topic: str, bootstrap: str, group_id: str | None = None,
               offsets: Mapping[int, int] | None = None,
               max_per_trigger: int | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """Kafka topic as a stream of ``value`` text plus source metadata."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(topic, bootstrap, group_id, offsets, max_per_trigger,
                              min_partitions).items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.select(F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-backed stream (replays, tests): new files under ``path`` become batches."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """One warehouse table (``<sf_dir>/<name>.parquet``) as a stream."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return file_stream(spark, sf_dir, schema, glob=f"{name}.parquet",
                       max_files_per_trigger=max_files_per_trigger)
