"""Sinks: the dt-partitioned DAU table and the per-topic fact feed.

Batch and streaming frames go through the same functions.  Streams use
Spark's native file sink (exactly-once through its commit log) or the
Kafka sink; each streaming write has its own checkpoint folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.schemas import DAU_INFO, FIRST_SEEN
from ..operators import cdc
from ..operators.dau import dedup, first_seen, incremental
from ..session import scratch_path


def apply_trigger(writer, trigger: str | None):
    """``None``/``"availableNow"`` (run what is there, then stop), ``"once"``, or a
    processing-time interval such as ``"5 seconds"``."""
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def dau_table(df: DataFrame, path: str, checkpoint: str | None = None,
              trigger: str | None = None, query_name: str | None = None,
              mode: str = "append"):
    """Write DAU rows to a parquet table partitioned by event ``dt``.

    A device-day is stored once: the stream dedup guarantees it per run
    and the checkpoint keeps it across restarts.  Batch writes append, or
    with ``mode="upsert"`` keep one row per ``(dt, mid)`` (see
    ``upsert_days``).  Returns the streaming query for a stream, else None.
    """
    if df.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming write needs a checkpoint folder")
        w = (df.writeStream.format("parquet").outputMode("append").partitionBy("dt")
               .option("checkpointLocation", checkpoint))
        if query_name:
            w = w.queryName(query_name)
        return apply_trigger(w, trigger).start(path)
    if mode == "upsert":
        upsert_days(df, path)
    elif mode == "append":
        df.write.mode("append").partitionBy("dt").parquet(path)
    else:
        raise ValueError("mode must be 'append' or 'upsert'")
    return None


def exists(spark, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def overwrite_partitions(df: DataFrame, path: str, column: str, *order: Column) -> None:
    """Replace the partitions that ``df`` has rows of; all others keep their files.

    ``df`` may read the table at ``path``: the new files are complete before the old ones go.
    Rows are dealt by partition, a large one to several tasks, so that few files are written, each in ``order`` if given.
    """
    dealt = df.hint("rebalance", column)
    if order:
        dealt = dealt.sortWithinPartitions(column, *order)
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


def staged_days(facts: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> tuple[DataFrame, list[str]]:
    """A batch's first row per device-day, written beside the tables by day, and its days.

    The batch is computed once: its days (one entry per calendar day) come from that listing.
    """
    spark = facts.sparkSession
    staged = scratch_path(spark, "dau-batch")
    first = dedup(facts, order=order).select(*DAU_INFO.fieldNames()).hint("rebalance", "dt")
    first.write.mode("overwrite").partitionBy("dt").parquet(staged)
    batch = read_dau_table(spark, staged).select(*DAU_INFO.fieldNames())
    return batch, [r.dt for r in batch.select("dt").distinct().collect()]


def upsert_days(df: DataFrame, path: str) -> None:
    """Merge a batch into the stored days it touches: one row per ``(dt, mid)``, the earliest.

    The batch is computed once; only its days are read and rewritten, by a
    dynamic partition overwrite, so a run that fails leaves the stored days
    and a repeated run changes nothing.
    """
    batch, days = staged_days(df.select(*DAU_INFO.fieldNames()), order=("ts",))
    if not days:
        return
    if (stored := _stored_days(df.sparkSession, path, days)) is not None:
        batch = dedup(stored.unionByName(batch), order=("ts",))
    overwrite_partitions(batch, path, "dt")


def add_absent(facts: DataFrame, path: str) -> DataFrame:
    """Detail rows of a batch whose ``(dt, mid)`` the table at ``path`` does not hold yet.

    The batch is read once: its first row per device-day is written beside
    the table, by day, so that its days are known from that listing and the
    stored side reads only the partitions of those days.
    """
    batch, days = staged_days(facts)
    stored = _stored_days(facts.sparkSession, path, days)
    return batch if stored is None else incremental(batch, stored, days=days)


def _bucketed_name(path: str) -> str:
    return f"dau_{hashlib.sha256(path.encode()).hexdigest()[:20]}"


def bucketed_table(spark, path: str, buckets: int = 32) -> DataFrame | None:
    """The device-bucketed day table at ``path``, or None where there is none yet.

    The bucketing is the session catalog's knowledge, so a session that does
    not know the table is told about it; partitions are found by listing.
    """
    if not exists(spark, path):
        return None
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DAU_INFO.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (dt) "
                  f"CLUSTERED BY (mid) SORTED BY (mid) INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def append_bucketed(df: DataFrame, path: str, buckets: int = 32) -> None:
    """Append DAU rows to the table at ``path``: partitions by day, ``buckets`` buckets by device in each.

    Rows are dealt by the buckets' own hash first, so a load writes one file
    per day and bucket.
    """
    spark = df.sparkSession
    known = bucketed_table(spark, path, buckets) is not None
    rows = df.select(*DAU_INFO.fieldNames()).repartition(buckets, "mid")
    writer = rows.write.mode("append").format("parquet").partitionBy("dt").bucketBy(buckets, "mid").sortBy("mid")
    (writer if known else writer.option("path", path)).saveAsTable(_bucketed_name(path))


def add_absent_bucketed(facts: DataFrame, path: str, buckets: int = 32) -> DataFrame:
    """As ``add_absent``, for the device-bucketed table: the stored side is not shuffled.

    Both sides meet by device alone, which the buckets are dealt by; the day
    is compared inside, as two bounds, because as a key it would call for a
    new distribution of the stored rows.
    """
    batch, days = staged_days(facts)
    stored = bucketed_table(facts.sparkSession, path, buckets)
    if stored is None:
        return batch
    old = stored.where(F.col("dt").isin(days)).select(F.col("mid").alias("_mid"), F.col("dt").alias("_dt")).hint("merge")
    met = (F.col("mid") == F.col("_mid")) & (F.col("dt") <= F.col("_dt")) & (F.col("dt") >= F.col("_dt"))
    return batch.join(old, met, "left_anti")


def first_seen_table(dau: DataFrame, path: str) -> None:
    """Bring the stored first day of each device up to date; partitioned by ``first_dt``.

    Only devices whose first day is new or earlier than the stored one
    change, so only the partitions they enter or leave are rewritten (their
    list is at most one entry per calendar day).  A repeated run changes nothing.
    """
    spark = dau.sparkSession
    fresh = first_seen(dau)
    if not exists(spark, path):
        fresh.write.partitionBy("first_dt").parquet(path)
        return
    stored = read_first_seen(spark, path)
    old = stored.select("mid", F.col("first_dt").alias("old_dt"))
    changed = fresh.join(old, "mid", "left").where(F.col("old_dt").isNull() | (F.col("first_dt") < F.col("old_dt")))
    staged = scratch_path(spark, "first-seen-changes")
    changed.write.mode("overwrite").parquet(staged)
    changed = spark.read.schema("mid string, first_dt string, old_dt string").parquet(staged)
    days = changed.select(F.explode(F.array("first_dt", "old_dt")).alias("dt")).where("dt is not null").distinct().collect()
    if not days:
        return
    kept = stored.where(F.col("first_dt").isin([r.dt for r in days])).join(changed.select("mid"), "mid", "left_anti")
    # A row without device in each of these partitions, so that one which all its devices leave is overwritten too.
    marks = spark.createDataFrame([(None, r.dt) for r in days], FIRST_SEEN)
    merged = kept.select("mid", "first_dt").unionByName(changed.select("mid", "first_dt")).unionByName(marks)
    overwrite_partitions(merged, path, "first_dt")


def read_first_seen(spark, path: str) -> DataFrame:
    """``(mid, first_dt)``; a filter on ``first_dt`` reads the partitions of those days only."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no first days in {path}")
    return spark.read.schema(FIRST_SEEN).parquet(path).where(F.col("mid").isNotNull())


def _stored_days(spark, path: str, days: list[str]) -> DataFrame | None:
    """Stored rows of ``days``, or None where there is no table yet."""
    if not exists(spark, path):
        return None
    return read_dau_table(spark, path).where(F.col("dt").isin(days)).select(*DAU_INFO.fieldNames())


def read_dau_table(spark, path: str, columns=None) -> DataFrame:
    """Read the DAU table back with ``dt`` kept as text."""
    fields = [f for f in DAU_INFO.fields if columns is None or f.name in columns]
    if columns is not None and "dt" not in columns:
        fields.append(T.StructField("dt", T.StringType()))
    return spark.read.schema(T.StructType(fields)).parquet(path)


def topic_fanout(df: DataFrame, fmt: str = "parquet", path: str | None = None,
                 bootstrap: str | None = None, key_col: str | None = None,
                 checkpoint: str | None = None, trigger: str | None = None,
                 query_name: str | None = None):
    """Write ``(topic, value)`` rows to their topics, a variant ``value`` as JSON text.

    ``fmt="kafka"`` sends each row to the topic named in its ``topic``
    column (keyed by ``key_col`` when given, so one key stays ordered in
    one partition); the file form writes one folder per topic.
    """
    text = cdc.as_text() if dict(df.dtypes)["value"] == "variant" else F.col("value").cast("string")
    cols = [F.col("topic"), text.alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    out = df.select(*cols)
    if fmt == "kafka":
        if df.isStreaming:
            w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                    .option("checkpointLocation", checkpoint))
            if query_name:
                w = w.queryName(query_name)
            return apply_trigger(w, trigger).start()
        out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()
        return None
    if df.isStreaming:
        w = (out.writeStream.format(fmt).outputMode("append").partitionBy("topic")
                .option("checkpointLocation", checkpoint))
        if query_name:
            w = w.queryName(query_name)
        return apply_trigger(w, trigger).start(path)
    out.write.mode("append").partitionBy("topic").format(fmt).save(path)
    return None


def changelog(df: DataFrame, path: str, checkpoint: str | None = None,
              trigger: str | None = None, query_name: str | None = None):
    """Append dimension changelog rows (``dim_rows`` output) to parquet."""
    if df.isStreaming:
        w = (df.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", checkpoint))
        if query_name:
            w = w.queryName(query_name)
        return apply_trigger(w, trigger).start(path)
    df.write.mode("append").parquet(path)
    return None


def await_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if q is not None:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
