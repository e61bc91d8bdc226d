"""Registered streaming queries: each runs its stream to the end of the
available input (``availableNow``) and returns the sink's contents.

They are the streaming twins of batch queries and share their oracle.
Output goes to a fresh folder under the session's checkpoint folder.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks
from ..operators import cdc
from ..session import ensure_utc, scratch_path
from ..sinks import dim_store
from ..sources.adapters import cdc_raw, raw_log, raw_log_from
from ..sources.streams import file_stream, table_stream
from ..streaming import cdc_stream, dau_stream, progress, sale_stream


# Streaming queries of each registered query's last run, for progress reporting (bench).
LAST_RUN: dict[str, list] = {}

# Size of the change stream's files, and how many a micro-batch takes per core.
CDC_FILE_RECORDS, CDC_FILES_PER_CORE = 40_000, 4


def _dealt(rows: DataFrame, base: str) -> DataFrame:
    """``rows`` written once, in folders by their ``part``; rows without a part are left out."""
    fields = [f.name for f in rows.schema.fields if f.name != "part"]
    whole = rows.where("part is not null").select(*fields, F.col("part").cast("int").alias("part"))
    whole.write.partitionBy("part").parquet(f"{base}/all")
    return rows.sparkSession.read.schema(whole.schema).parquet(f"{base}/all")


def _arrive(dealt: DataFrame, part: int, path: str) -> T.StructType:
    """Add one part to the stream's source, in as many files as tasks write it; the source's schema.

    A run without a limit on files takes all of them as one micro-batch.
    """
    rows = dealt.where(F.col("part") == part).drop("part")
    rows.write.mode("append").parquet(path)
    return rows.schema


def _released(spark: SparkSession, base: str, part: int, path: str) -> None:
    """Add one part that ``_dealt`` wrote below ``base`` to the stream's source: its files as they are, not written again."""
    jvm = spark.sparkContext._jvm
    folder, source = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{base}/all/part={part}", path))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(source)
    if not fs.exists(folder):
        return
    for file in [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")]:
        # A task gives its files of all parts one name.
        if not fs.rename(file, jvm.org.apache.hadoop.fs.Path(source, f"part-{part}-{file.getName()}")):
            raise RuntimeError(f"{file} could not be moved to {path}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def run_dau_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> str:
    ensure_utc(spark)
    base = scratch_path(spark, "dau_stream")
    raw = raw_log_from(table_stream(spark, sf_dir, "events", max_files_per_trigger))
    # Unnamed: two registered runs may overlap in one session.
    q = dau_stream.start(raw, f"{base}/table", f"{base}/checkpoint", query_name=None)
    sinks.await_all([q])
    LAST_RUN["dau_stream"] = [q]
    return f"{base}/table"


def run_cdc_stream(spark: SparkSession, sf_dir: str) -> str:
    """Write the change log once (from the tables), then stream it through the
    one-pass router; returns the routed output folder."""
    ensure_utc(spark)
    base = scratch_path(spark, "cdc_stream")
    # Files of a bounded number of messages, as a topic hands them out over time.
    cdc_raw(spark, sf_dir).write.option("maxRecordsPerFile", CDC_FILE_RECORDS).parquet(f"{base}/source")
    schema = spark.read.parquet(f"{base}/source").schema
    # A micro-batch is bounded per core, so that the number of batches depends on the messages a core gets.
    files = CDC_FILES_PER_CORE * max(2, spark.sparkContext.defaultParallelism)
    raw = file_stream(spark, f"{base}/source", schema, max_files_per_trigger=files)
    q = cdc_stream.start_single(raw, f"{base}/routed", f"{base}/checkpoint", query_name=None)
    sinks.await_all([q])
    LAST_RUN["cdc_stream"] = LAST_RUN["dim_stream_latest"] = [q]
    return f"{base}/routed"


def q_dau_stream(spark, sf_dir):
    path = run_dau_stream(spark, sf_dir)
    return sinks.read_dau_table(spark, path, columns=("mid", "dt")).select("dt", "mid")


def q_cdc_stream(spark, sf_dir):
    routed = cdc_stream.read_routed(spark, run_cdc_stream(spark, sf_dir))
    return cdc.facts_of(routed).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def q_dim_stream_latest(spark, sf_dir):
    routed = cdc_stream.read_routed(spark, run_cdc_stream(spark, sf_dir))
    latest = cdc.dim_latest(cdc.dim_log_of(routed))
    return latest.groupBy("dim_table").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count(F.when(F.col("type") == cdc.OP_UPDATE, 1)).alias("n_updated"),
        F.count(F.when(F.col("type") == cdc.OP_DELETE, 1)).alias("n_deleted"),
    )


def q_dau_stream_disorder(spark, sf_dir):
    """Device-days stored and messages rejected by a stream whose parts arrive out of order.

    The log comes in four parts, one per micro-batch, the newest part first; the
    first part also repeats some messages with a clock 75 years ahead, and the
    stream is stopped and resumed after every part.
    """
    ensure_utc(spark)
    base = scratch_path(spark, "dau_disorder")
    raw = raw_log(spark, sf_dir)
    # Part by hour: every part holds all days.
    hour = F.hour(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint")))
    ahead = F.regexp_replace("value", '"ts":([0-9]{2})', '"ts":4$1')
    clock = F.lit("2024-01-31 00:00:00").cast("timestamp")
    rows = raw.select("value", F.floor(hour / 6).alias("part"))
    rows = rows.unionByName(raw.where("event_id % 50 = 7").select(ahead.alias("value"), F.lit(3).alias("part")))
    dealt = _dealt(rows, base)
    for part in (3, 0, 2, 1):
        stream = file_stream(spark, f"{base}/source", _arrive(dealt, part, f"{base}/source"))
        queries = [dau_stream.start(stream, f"{base}/table", f"{base}/ck", clock=clock, query_name=None),
                   dau_stream.start_rejects(stream, f"{base}/rejects", f"{base}/ck_rejects", clock, query_name=None)]
        sinks.await_all(queries)
    LAST_RUN["dau_stream_disorder"] = queries
    stored = sinks.read_dau_table(spark, f"{base}/table", columns=("mid", "dt")).select("dt", "mid", F.lit("stored").alias("outcome"))
    rejected = spark.read.parquet(f"{base}/rejects").select(
        F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd").alias("dt"), "mid", F.col("fault").alias("outcome"))
    return stored.unionByName(rejected)


# Fixed parameters of the enrichment stream: when its parts of the log were written.
SALE_START, SALE_STEP_MINUTES, SALE_PARTS = "2024-03-01 00:00:00", 20, 4


def q_sale_enriched_stream(spark, sf_dir):
    """Order lines enriched as they come, in four parts with a restart after each; every order comes a part after its lines.

    Lines whose order never comes go out when later messages have moved the watermark.
    """
    ensure_utc(spark)
    base = scratch_path(spark, "sale_stream")
    routed = cdc.route_all(cdc.valid(cdc.parse(cdc_raw(spark, sf_dir))))
    routed.write.partitionBy("route").parquet(f"{base}/routed")
    routed = cdc_stream.read_routed(spark, f"{base}/routed")
    dim_store.compact(spark, f"{base}/routed", f"{base}/store", pick=cdc.dim_log_of)
    images = dim_store.read_images(spark, f"{base}/store")

    def messages(kind: str, order_key: str, lag: int):
        """The messages of one kind with their part and the time it was written."""
        part = cdc.field(order_key, "bigint") % SALE_PARTS + lag
        rows = routed.where(F.col("route").startswith(f"DWD_{kind}_")).select("value", part.alias("part"))
        minutes = F.make_dt_interval(mins=(F.col("part") * SALE_STEP_MINUTES).cast("int"))
        return rows.withColumn("at", F.lit(SALE_START).cast("timestamp") + minutes)

    # Messages of a day later, twice: the watermark that the first ones move holds from the next batch on.
    # They are never closed themselves, so they don't go out.
    closing = spark.range(2).select(F.parse_json(F.lit('{"id":-1,"order_id":-2}')).alias("value"), (F.col("id") + SALE_PARTS + 1).alias("part"),
                                    (F.lit(SALE_START).cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("at"))
    kinds = {"lines": messages("ORDER_DETAIL", "order_id", 0), "orders": messages("ORDER_INFO", "id", 1)}
    schemas = {name: _dealt(rows.unionByName(closing), f"{base}/{name}").drop("part").schema for name, rows in kinds.items()}
    # Every part is followed by another: a batch without messages after each would only search the state once more.
    with _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):
        for part in range(SALE_PARTS + 3):
            for name in schemas:
                _released(spark, f"{base}/{name}", part, f"{base}/source/{name}")
            streams = [file_stream(spark, f"{base}/source/{name}", schema) for name, schema in schemas.items()]
            queries = [sale_stream.start(*streams, images, f"{base}/out", f"{base}/ck", query_name=None)]
            sinks.await_all(queries)
    LAST_RUN["sale_enriched_stream"] = queries
    return spark.read.parquet(f"{base}/out")


def q_dau_hourly_stream(spark, sf_dir):
    """Devices per day and hour from a stream whose parts arrive out of order, with a restart after each."""
    ensure_utc(spark)
    base = scratch_path(spark, "dau_hourly")
    raw = raw_log(spark, sf_dir).select("value")
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    dealt = _dealt(raw.select("value", F.floor(F.hour(F.timestamp_millis(ts)) / 6).alias("part")), base)
    # Session starts long after the last day, twice: the watermark that the first moves holds from the next batch on.
    # Their own day stays open, so it doesn't go out.
    closing = dealt.agg(F.max(ts).alias("ts")).select(F.to_json(F.struct(
        (F.col("ts") + 86_400_000 * 90).alias("ts"), F.struct(F.lit("0").alias("mid")).alias("common"),
        F.struct(F.lit("").alias("last_page_id")).alias("page"))).alias("value"))
    for part in (3, 0, 2, 1, None, None):
        if part is None:
            closing.write.mode("append").parquet(f"{base}/source")
        else:
            schema = _arrive(dealt, part, f"{base}/source")
        stream = file_stream(spark, f"{base}/source", schema)
        queries = [dau_stream.start_hourly(stream, f"{base}/table", f"{base}/ck", query_name=None)]
        sinks.await_all(queries)
    LAST_RUN["dau_hourly_stream"] = queries
    return spark.read.schema("hr string, cnt long, dt string").parquet(f"{base}/table").select("dt", "hr", "cnt")


def q_dau_late_merge(spark, sf_dir):
    """Device-days stored by the stream and those its late messages add afterwards.

    A quarter of the log arrives weeks after the rest: what is older than the
    stream takes goes to the rejects, and from there into its days, in two runs.
    """
    ensure_utc(spark)
    base = scratch_path(spark, "dau_late")
    raw = raw_log(spark, sf_dir)
    ts = F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint"))
    dealt = _dealt(raw.select("value", F.floor(F.hour(ts) / 8).alias("part")), base)
    for part, arrived in ((0, "2024-01-31 12:00:00"), (1, "2024-02-25 00:00:00"), (2, "2024-03-05 00:00:00")):
        schema = _arrive(dealt.withColumn("arrived", F.lit(arrived).cast("timestamp")), part, f"{base}/source")
        stream = file_stream(spark, f"{base}/source", schema)
        clock = F.col("arrived")
        sinks.await_all([dau_stream.start(stream, f"{base}/table", f"{base}/ck", clock=clock, query_name=None),
                         dau_stream.start_rejects(stream, f"{base}/rejects", f"{base}/ck_rejects", clock, query_name=None)])
        if part:
            rejected = file_stream(spark, f"{base}/rejects", dau_stream.REJECTS)
            late = dau_stream.start_late_merge(rejected, f"{base}/table", f"{base}/late", f"{base}/ck_late", query_name=None)
            sinks.await_all([late])
            LAST_RUN["dau_late_merge"] = [late]
    return dau_stream.read_with_late(spark, f"{base}/table", f"{base}/late").select("dt", "mid")


# Lateness that the state query runs with.
STATE_DELAY_DAYS = 3


def q_dau_state_days(spark, sf_dir):
    """Days and devices that the dedup still holds in state when the log has come in order."""
    ensure_utc(spark)
    base = scratch_path(spark, "dau_state")
    raw = raw_log(spark, sf_dir).select("value")
    day = F.dayofmonth(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint")))
    dealt = _dealt(raw.select("value", F.least(F.floor((day - 1) / 10), F.lit(2)).alias("part")), base)
    for part in (0, 1, 2, 2):  # ten days each; the last days come twice, as the watermark holds from the next batch on
        stream = file_stream(spark, f"{base}/source", _arrive(dealt, part, f"{base}/source"))
        sinks.await_all([q := dau_stream.start(stream, f"{base}/table", f"{base}/ck", delay=f"{STATE_DELAY_DAYS} days", query_name=None)])
    LAST_RUN["dau_state_days"] = [q]
    return progress.state_days(spark, f"{base}/ck")


QUERIES = {
    "dau_late_merge": q_dau_late_merge,
    "dau_state_days": q_dau_state_days,
    "sale_enriched_stream": q_sale_enriched_stream,
    "dau_hourly_stream": q_dau_hourly_stream,
    "dau_stream_disorder": q_dau_stream_disorder,
    "dau_stream": q_dau_stream,
    "cdc_stream": q_cdc_stream,
    "dim_stream_latest": q_dim_stream_latest,
}
