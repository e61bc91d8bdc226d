"""Runnable jobs: the DAU stream, the change-record router, the bootstrap snapshot, and the stores' upkeep.

    python -m tidemark.streaming.jobs dau --bootstrap host:9092 --topic ODS_BASE_LOG \
        --table <dau table folder> --checkpoint <checkpoint folder>
    python -m tidemark.streaming.jobs cdc --bootstrap host:9092 --topic ODS_BASE_DB_C \
        --facts kafka --checkpoint <folder>
    python -m tidemark.streaming.jobs late --table <dau table folder> --checkpoint <folder>
    python -m tidemark.streaming.jobs snapshot --jdbc-url jdbc:... --bootstrap host:9092
    python -m tidemark.streaming.jobs compact --dim-log <changelog or routed folder> --store <folder>
    python -m tidemark.streaming.jobs first-seen --table <dau table folder> --store <folder> [--day 2024-01-15]

``--source file --source-path <folder>`` reads JSON-lines files with a
``value`` field instead of Kafka (replays, tests).  Streams run with a 5 s
processing-time trigger unless ``--trigger availableNow`` is given.
Position and state live in the checkpoint folder: a restart resumes there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks
from ..operators import cdc, serving
from ..session import BASE_CONF
from ..sinks import dim_store
from ..sources.jdbc import keyed_scan
from ..sources.streams import file_stream, log_stream
from . import cdc_stream, dau_stream

# File replays: JSON lines with the message text and, optionally, its log position.
FILE_RECORD = T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())])
DIM_SOURCE_TABLES = cdc.DIM_TABLES


def _source(spark: SparkSession, args, with_seq: bool = False) -> DataFrame:
    """``value`` and ``seq``, the log position, or else ``arrived``, when the record was written.

    On Kafka the position is ``(timestamp, partition, offset)``: a key that moved to
    another partition keeps its order by time, and offsets order what one instant wrote.
    """
    if args.source == "file":
        df = file_stream(spark, args.source_path, FILE_RECORD, fmt="json",
                         max_files_per_trigger=args.max_files)
        return df.select("seq", "value") if with_seq else \
            df.select("value", F.col("_metadata.file_modification_time").alias("arrived"))
    offsets = None
    if args.offsets:
        offsets = {int(p): int(o) for p, o in (kv.split(":") for kv in args.offsets.split(","))}
    df = log_stream(spark, args.topic, args.bootstrap, args.group, offsets, args.max_per_trigger,
                    args.min_partitions)
    if with_seq:
        return df.select(F.struct("timestamp", "partition", "offset").alias("seq"), "value")
    return df.select("value", F.col("timestamp").alias("arrived"))


def dau_job(spark: SparkSession, args):
    raw = _source(spark, args)
    clock = None if args.replay else F.col("arrived")
    main = dau_stream.start(raw, args.table, args.checkpoint, delay=args.delay, clock=clock,
                            trigger=args.trigger, sink_partitions=args.sink_partitions)
    rejects = dau_stream.start_rejects(raw, args.rejects or f"{args.table.rstrip('/')}_rejects",
                                       f"{args.checkpoint.rstrip('/')}_rejects", clock, args.delay, args.trigger)
    return [main, rejects]


def late_job(spark: SparkSession, args):
    """Stream the late messages among the rejects into the table beside the streamed one."""
    rejected = file_stream(spark, args.rejects or f"{args.table.rstrip('/')}_rejects", dau_stream.REJECTS)
    return dau_stream.start_late_merge(rejected, args.table, f"{args.table.rstrip('/')}_late", args.checkpoint, trigger=args.trigger)


def cdc_job(spark: SparkSession, args):
    """One-pass router by default; ``--two-queries`` runs the arms separately."""
    raw = _source(spark, args, with_seq=True)
    fmt = "kafka" if args.facts == "kafka" else "parquet"
    rejects = cdc_stream.start_rejects(raw, args.rejects or f"{args.checkpoint.rstrip('/')}_rejected_rows",
                                       f"{args.checkpoint.rstrip('/')}_rejects", args.trigger)
    if args.two_queries:
        return [rejects, *cdc_stream.start(raw, args.dim_log, args.facts if fmt == "parquet" else None,
                                args.checkpoint, fact_format=fmt, bootstrap=args.bootstrap,
                                trigger=args.trigger)]
    return [rejects, cdc_stream.start_single(raw, args.facts if fmt == "parquet" else None, args.checkpoint,
                                             fmt=fmt, bootstrap=args.bootstrap, trigger=args.trigger)]


def publish_snapshot(tables: dict[str, DataFrame], topic: str, out: str | None = None,
                     bootstrap: str | None = None) -> None:
    """One INSERT envelope per row of each table, sent to the change topic
    (Kafka) or written under ``out/topic=<topic>`` (files)."""
    env = cdc.snapshot_envelopes(tables).withColumn("topic", F.lit(topic))
    if out:
        sinks.topic_fanout(env, path=out, key_col="key")
    else:
        sinks.topic_fanout(env, fmt="kafka", bootstrap=bootstrap, key_col="key")


def snapshot_job(spark: SparkSession, args) -> None:
    """Read the dimension tables over JDBC and publish one envelope per row."""
    tables = {t: keyed_scan(spark, args.jdbc_url, t, args.partition_column, args.num_partitions,
                            user=args.user, password=args.password) for t in DIM_SOURCE_TABLES}
    publish_snapshot(tables, args.topic, args.out, args.bootstrap)


def compact_job(spark: SparkSession, args) -> list[int]:
    """Merge the changelog files written since the last run into the dimension store."""
    def pick(log: DataFrame) -> DataFrame:
        return cdc.dim_log_of(log) if "route" in log.columns else log
    return dim_store.compact(spark, args.dim_log, args.store, pick=pick)


def first_seen_job(spark: SparkSession, args) -> None:
    """Merge a DAU table, or one day of it, into the first-seen table."""
    sinks.first_seen_table(serving.dau_scan(spark, args.table, args.day), args.store)


STREAM_JOBS = {"dau": dau_job, "cdc": cdc_job, "late": late_job}
BATCH_JOBS = {"snapshot": snapshot_job, "compact": compact_job, "first-seen": first_seen_job}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark.streaming.jobs")
    p.add_argument("job", choices=(*STREAM_JOBS, *BATCH_JOBS))
    p.add_argument("--bootstrap")
    p.add_argument("--topic")
    p.add_argument("--group")
    p.add_argument("--offsets", help="first start only: partition:offset,partition:offset")
    p.add_argument("--max-per-trigger", type=int, help="cap on Kafka records per micro-batch")
    p.add_argument("--min-partitions", type=int, help="split Kafka partitions into more tasks")
    p.add_argument("--sink-partitions", type=int, help="dau: writers per micro-batch (fewer files)")
    p.add_argument("--source", choices=("kafka", "file"), default="kafka")
    p.add_argument("--source-path")
    p.add_argument("--max-files", type=int)
    p.add_argument("--table")
    p.add_argument("--dim-log")
    p.add_argument("--facts", default="kafka", help="'kafka' or an output folder")
    p.add_argument("--two-queries", action="store_true",
                   help="cdc: dimension and fact arms as two queries (--dim-log for the first)")
    p.add_argument("--checkpoint")
    p.add_argument("--rejects", help="folder for messages that are not taken (default: beside the table or checkpoint)")
    p.add_argument("--replay", action="store_true", help="dau: history, do not hold event times against the current time")
    p.add_argument("--delay", default=dau_stream.DEFAULT_DELAY)
    p.add_argument("--trigger", default=dau_stream.BATCH_INTERVAL)
    p.add_argument("--jdbc-url")
    p.add_argument("--partition-column", default="id", help="snapshot: numeric key that splits each table's scan")
    p.add_argument("--num-partitions", type=int, default=8, help="snapshot: parallel range scans of a table")
    p.add_argument("--store", help="compact, first-seen: folder of the store")
    p.add_argument("--day", help="first-seen: merge this day only")
    p.add_argument("--user")
    p.add_argument("--password")
    p.add_argument("--out", help="snapshot: write per-topic folders here instead of Kafka")
    p.add_argument("--spark-ui", action="store_true", help="start Spark's web UI (off by default)")
    return p


REQUIRED = {
    "dau": ("table", "checkpoint"),
    "cdc": ("checkpoint",),
    "late": ("table", "checkpoint"),
    "snapshot": ("jdbc_url", "topic"),
    "compact": ("dim_log", "store"),
    "first-seen": ("table", "store"),
}


def main(argv: list[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(argv)
    missing = [f"--{a.replace('_', '-')}" for a in REQUIRED[args.job] if getattr(args, a) is None]
    stream = args.job in STREAM_JOBS
    reads = stream and args.job != "late"
    if reads and args.source == "kafka":
        missing += [f"--{a}" for a in ("bootstrap", "topic") if getattr(args, a) is None]
    if reads and args.source == "file" and args.source_path is None:
        missing.append("--source-path")
    if args.job == "snapshot" and not args.out and args.bootstrap is None:
        missing.append("--bootstrap (or --out)")
    if missing:
        p.error(f"{args.job} needs {', '.join(missing)}")
    builder = SparkSession.builder.appName(f"tidemark-{args.job}")
    for k, v in (BASE_CONF | {"spark.ui.enabled": "true" if args.spark_ui else "false"}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not stream:
        BATCH_JOBS[args.job](spark, args)
        return
    qs = STREAM_JOBS[args.job](spark, args)
    sinks.await_all(qs if isinstance(qs, list) else [qs])


if __name__ == "__main__":
    main()
