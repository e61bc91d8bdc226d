"""DAU as a Structured Streaming job.

``raw log stream -> parse -> dt/hr -> session starts -> facts -> dedup ->
dt-partitioned parquet``.  The dedup is Spark's state store keyed by
``(day_ts, mid)``: a device-day seen in any earlier micro-batch is never
emitted again, also after a restart from the same checkpoint.  The
watermark on ``day_ts`` (event day) bounds the state: a day's keys are
dropped once the watermark passes it, and rows of such a day arriving
later are dropped as late instead of being counted twice (Spark filters
late rows against the previous batch's watermark).  With a ``clock``, rows
too far ahead of it or too old are taken out before the watermark and go
to the rejects (``start_rejects``), so that none is lost silently.  The
clock is the record's own arrival time: the main query and the rejects
query run their batches apart and must judge a message alike.  Late
messages join their day afterwards (``start_late_merge``).  Before
the state shuffle, a map-side pre-dedup keeps one row per key and Arrow
batch, so a hot device cannot flood one state task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dau as dau_ops
from ..operators import logs
from .. import sinks

# Default lateness bound.  It must cover the real disorder of the input:
# a bound shorter than the disorder drops rows as late.
DEFAULT_DELAY = "40 days"
# Production micro-batch interval (tests and replays use availableNow).
BATCH_INTERVAL = "5 seconds"


# What the rejects folder holds.
REJECTS = T.StructType([T.StructField("fault", T.StringType()), T.StructField("ts", T.LongType()),
                        T.StructField("mid", T.StringType()), T.StructField("value", T.StringType())])

# How far ahead of the clock an event time may lie (device clocks drift).
FUTURE_TOLERANCE = "1 day"


def _first_in_batch(keys: tuple[str, ...]):
    def run(batches):
        for pdf in batches:
            yield pdf.loc[~pdf.duplicated(subset=list(keys))]
    return run


def predup_in_batches(df: DataFrame, keys: tuple[str, ...] = ("dt", "mid")) -> DataFrame:
    """Drop repeats of a key inside each Arrow batch, before any shuffle.

    Streaming dedup has no map-side step: every row of a device goes to
    the one task owning its key.  One row per key and batch (10,000 rows)
    is what a hot device sends at most.  It keeps no state, so it behaves
    alike at every size; the stateful dedup after it stays exact.
    """
    return df.mapInPandas(_first_in_batch(tuple(keys)), df.schema)


def outside(clock: Column, delay: str = DEFAULT_DELAY, tolerance: str = FUTURE_TOLERANCE) -> Column:
    """``future`` or ``late`` for an event time outside [clock - delay, clock + tolerance], else null.

    Applied before the watermark: a row with a wrong clock cannot move it,
    and no row that passes is behind it (the watermark's own delay is
    longer by the tolerance and a day), so Spark drops none silently.
    """
    ts = F.timestamp_millis("ts")
    return (F.when(ts > clock + F.expr(f"interval {tolerance}"), "future")
            .when(ts < clock - F.expr(f"interval {delay}"), "late"))


def rejects(raw: DataFrame, clock: Column | None = None, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Messages the stream does not take: ``fault`` and the message, ``ts``, ``mid`` where known."""
    parsed = logs.parse(raw.withColumn("_message", F.col("value")))
    fault = logs.fault() if clock is None else F.coalesce(logs.fault(), outside(clock, delay))
    return parsed.select(fault.alias("fault"), "ts", F.col("common.mid").alias("mid"),
                         F.col("_message").alias("value")).where(F.col("fault").isNotNull())


def start_rejects(raw: DataFrame, path: str, checkpoint: str, clock: Column | None = None, delay: str = DEFAULT_DELAY,
                  trigger: str | None = None, query_name: str | None = "dau_rejects"):
    """Second query over the same source: bad, future and late messages go to ``path``."""
    return sinks.changelog(rejects(raw, clock, delay), path, checkpoint, trigger=trigger, query_name=query_name)


def late_rows(rejected: DataFrame, stored: DataFrame) -> DataFrame:
    """Device-days of a stream of rejects that came too late and that ``stored`` (``dt, mid``) lacks.

    The dedup has no watermark: a late message may be of any day.  Its state
    grows with late device-days only.
    """
    facts = dau_ops.to_fact(logs.session_starts(logs.prepared(rejected.where(F.col("fault") == "late").select("value"))), keep=())
    keyed = facts.where(F.col("mid").isNotNull() & F.col("dt").isNotNull())
    absent = predup_in_batches(keyed).join(stored.select("dt", "mid"), ["dt", "mid"], "left_anti")
    return dau_ops.detail(absent.dropDuplicates(["dt", "mid"]))


def start_late_merge(rejected: DataFrame, table_path: str, late_path: str, checkpoint: str, trigger: str | None = None,
                     query_name: str | None = "dau_late"):
    """Add late device-days beside the streamed table; every reject is taken once (by the checkpoint).

    The streamed table belongs to its own query, so late days have a table of
    their own; ``read_with_late`` gives both as one.
    """
    stored = sinks.read_dau_table(rejected.sparkSession, table_path, columns=("mid", "dt"))
    return sinks.dau_table(late_rows(rejected, stored), late_path, checkpoint, trigger=trigger, query_name=query_name)


def read_with_late(spark, table_path: str, late_path: str) -> DataFrame:
    """The streamed table and the late device-days that it still lacks."""
    stored = sinks.read_dau_table(spark, table_path)
    late = sinks.read_dau_table(spark, late_path)
    return stored.unionByName(late.join(stored.select("dt", "mid"), ["dt", "mid"], "left_anti").select(*stored.columns))


def dedup_stream(facts: DataFrame, delay: str = DEFAULT_DELAY, map_side: bool = True) -> DataFrame:
    """Keep the first arriving row per ``(event day, mid)`` across micro-batches."""
    keyed = facts.where(F.col("mid").isNotNull() & F.col("dt").isNotNull())
    if map_side:
        keyed = predup_in_batches(keyed)
    keyed = keyed.withColumn("day_ts", F.date_trunc("day", F.timestamp_millis("ts")))
    return (keyed.withWatermark("day_ts", delay)
                 .dropDuplicates(["day_ts", "mid"])
                 .drop("day_ts"))


def dau_facts_stream(raw: DataFrame, delay: str = DEFAULT_DELAY, clock: Column | None = None) -> DataFrame:
    """Raw page-log stream -> deduplicated DAU rows (stamped with event time).

    Each micro-batch reports its session starts before and its new
    device-days after the dedup as observed metrics ``dau_in`` /
    ``dau_out`` in the query progress (``progress.observed``).
    """
    log = logs.prepared(raw)
    if clock is not None:
        log = log.where(outside(clock, delay).isNull())
    facts = dau_ops.to_fact(logs.session_starts(log), keep=())
    facts = facts.observe("dau_in", F.count(F.lit(1)).alias("rows"))
    if clock is not None:
        delay = f"{delay} {FUTURE_TOLERANCE} 1 day"
    out = dau_ops.detail(dedup_stream(facts, delay))
    return out.observe("dau_out", F.count(F.lit(1)).alias("rows"))


def hourly_stream(raw: DataFrame, delay: str = DEFAULT_DELAY, clock: Column | None = None) -> DataFrame:
    """Raw page-log stream -> ``dt, hr, cnt``: devices by the hour of their first session start of the day.

    Two stateful steps: the earliest start of each ``(event day, mid)``,
    whatever the order of arrival, then the count per day and hour.  Both
    are aggregates over the day window, so a hot device leaves each task as
    one row.  A day goes out, in at most 24 rows, when the watermark has
    passed it; its state is freed then.
    """
    log = logs.prepared(raw)
    if clock is not None:
        log = log.where(outside(clock, delay).isNull())
        delay = f"{delay} {FUTURE_TOLERANCE} 1 day"
    starts = logs.session_starts(log).select(F.timestamp_millis("ts").alias("ets"), F.col("common.mid").alias("mid"))
    starts = starts.where(F.col("mid").isNotNull()).withWatermark("ets", delay)
    first = starts.groupBy(F.window("ets", "1 day").alias("day"), "mid").agg(F.min("ets").alias("first_ets"))
    hours = first.groupBy("day", F.date_format("first_ets", "HH").alias("hr")).agg(F.count(F.lit(1)).alias("cnt"))
    return hours.select(F.date_format("day.start", "yyyy-MM-dd").alias("dt"), "hr", "cnt")


def start_hourly(raw: DataFrame, path: str, checkpoint: str, delay: str = DEFAULT_DELAY, clock: Column | None = None,
                 trigger: str | None = None, query_name: str | None = "dau_hourly"):
    """Start the hourly counts into a table partitioned by ``dt``; returns the query."""
    return sinks.dau_table(hourly_stream(raw, delay, clock), path, checkpoint, trigger=trigger, query_name=query_name)


def start(raw: DataFrame, table_path: str, checkpoint: str, delay: str = DEFAULT_DELAY,
          trigger: str | None = None, query_name: str | None = "dau",
          spread_to: int | None = None, sink_partitions: int | None = None, clock: Column | None = None):
    """Start the DAU stream into the dt-partitioned table; returns the query.

    ``clock`` is what event times are held against (``outside``): the time a
    record arrived (a column of ``raw``) for a live source, a fixed time or
    None for a replay of history.  Partitions read over a day behind the
    others may still lose rows to the watermark.  Without it a row behind the watermark is dropped by Spark.

    ``spread_to`` round-robins each micro-batch over that many tasks before
    the JSON parse.  Only for sources with too few splits (a replay of one
    small file); a Kafka source gets its parallelism from ``minPartitions``
    without a shuffle, so leave it None there.

    ``sink_partitions`` round-robins the deduplicated rows (new device-days
    only, a small fraction of the input) over that many writers.  Without
    it every state partition writes its own file per day per micro-batch:
    with hundreds of shuffle partitions and a 5 s trigger that is a flood
    of small files.
    """
    if spread_to:
        raw = raw.repartition(spread_to)
    out = dau_facts_stream(raw, delay, clock)
    if sink_partitions:
        out = out.repartition(sink_partitions)
    return sinks.dau_table(out, table_path, checkpoint, trigger=trigger, query_name=query_name)
