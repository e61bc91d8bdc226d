"""Per-batch source offsets and counters from a query's progress reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _get(obj, name):
    """Progress fields are attributes in newer PySpark and dict keys in older."""
    if isinstance(obj, dict):
        return obj.get(name)
    return getattr(obj, name, None)


def batch_offsets(query: StreamingQuery) -> list[dict]:
    """One entry per recent micro-batch: batch id, source offsets, input rows."""
    out = []
    for p in query.recentProgress:
        for s in _get(p, "sources") or []:
            out.append({
                "batchId": _get(p, "batchId"),
                "source": _get(s, "description"),
                "startOffset": _get(s, "startOffset"),
                "endOffset": _get(s, "endOffset"),
                "numInputRows": _get(s, "numInputRows"),
            })
    return out


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows dropped by the watermark over the recent batches.

    Reported by all stateful operators, the dedup included.
    """
    total = 0
    for p in query.recentProgress:
        for op in _get(p, "stateOperators") or []:
            total += _get(op, "numRowsDroppedByWatermark") or 0
    return total


def state_rows(query: StreamingQuery) -> int:
    """Rows held in state after the last batch."""
    last = query.lastProgress
    if last is None:
        return 0
    return sum(_get(op, "numRowsTotal") or 0 for op in _get(last, "stateOperators") or [])


def state_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Device-days that the dedup's state holds now: ``dt, devices`` (Spark's state data source).

    Reads the state of the last committed batch, so it shows what eviction has freed.
    """
    held = spark.read.format("statestore").load(checkpoint)
    return held.groupBy(F.date_format("key.day_ts", "yyyy-MM-dd").alias("dt")).agg(F.count(F.lit(1)).alias("devices"))


def observed(query: StreamingQuery) -> list[dict]:
    """Named metrics of each recent micro-batch (``DataFrame.observe`` in a stream)."""
    out = []
    for p in query.recentProgress:
        metrics = _get(p, "observedMetrics") or {}
        row = {"batchId": _get(p, "batchId")}
        for name, value in metrics.items():
            row[name] = value.asDict() if hasattr(value, "asDict") else value
        out.append(row)
    return out
