"""Change-record routing as Structured Streaming.

Default (``start_single``): one query, one pass over the source.  Every
data row is routed (``cdc.route_all``) to ``DIM_<TABLE>`` (dimension
images keyed by ``DIM:<TABLE>:<pk>``) or ``DWD_<TABLE>_<op>`` (fact
messages) and written by one sink: per-route folders, or Kafka where the
``DIM_*`` topics, keyed by the dimension key, act as a compacted
last-write-wins store.  Both outputs commit together with the source
position in one checkpoint.

``start`` is the two-query form: dimension arm and fact arm as separate
queries over the same source, each with its own checkpoint (the source is
read twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cdc
from .. import sinks


def arms(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dimension changelog rows, fact messages) of a raw change stream."""
    dims, facts = cdc.split(cdc.valid(cdc.parse(raw)))
    return cdc.dim_rows(dims), cdc.route_facts(facts)


def start(raw: DataFrame, dim_log_path: str, facts_path: str, checkpoint_root: str,
          fact_format: str = "parquet", bootstrap: str | None = None,
          trigger: str | None = None) -> list:
    """Start both arms; returns their streaming queries."""
    dim_rows, fact_msgs = arms(raw)
    q_dim = sinks.changelog(dim_rows, dim_log_path, f"{checkpoint_root}/dims",
                            trigger=trigger, query_name="cdc_dims")
    q_fact = sinks.topic_fanout(fact_msgs, fmt=fact_format, path=facts_path, bootstrap=bootstrap,
                                checkpoint=f"{checkpoint_root}/facts", trigger=trigger,
                                query_name="cdc_facts")
    return [q_dim, q_fact]


def start_single(raw: DataFrame, out_path: str | None, checkpoint: str,
                 fmt: str = "parquet", bootstrap: str | None = None,
                 trigger: str | None = None, query_name: str | None = "cdc"):
    """Start the one-pass router; returns its streaming query."""
    routed = cdc.route_all(cdc.valid(cdc.parse(raw)))
    if fmt == "kafka":
        msgs = routed.withColumnRenamed("route", "topic")
        return sinks.topic_fanout(msgs, fmt, bootstrap=bootstrap, key_col="msg_key", checkpoint=checkpoint,
                                  trigger=trigger, query_name=query_name)
    w = (routed.writeStream.format(fmt).outputMode("append").partitionBy("route")
               .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return sinks.apply_trigger(w, trigger).start(out_path)


def start_rejects(raw: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                  query_name: str | None = "cdc_rejects"):
    """Second query over the same source: all that routing leaves out goes to ``path``, with its fault."""
    return sinks.changelog(cdc.rejects(cdc.parse(raw)), path, checkpoint, trigger=trigger, query_name=query_name)


def read_routed(spark, out_path: str) -> DataFrame:
    """Read the one-pass router's folders back (``route`` kept as text)."""
    df = spark.read.parquet(out_path)
    return df.withColumn("route", F.col("route").cast("string"))


def run_batch(raw: DataFrame, dim_log_path: str, facts_path: str) -> None:
    """Batch form of both arms: the parsed change batch is reused by two
    writes, so it is persisted once (memory, spilling to disk; a lost block
    is recomputed from the source) and released afterwards."""
    from pyspark import StorageLevel

    parsed = cdc.valid(cdc.parse(raw)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dims, facts = cdc.split(parsed)
        sinks.changelog(cdc.dim_rows(dims), dim_log_path)
        sinks.topic_fanout(cdc.route_facts(facts), path=facts_path)
    finally:
        parsed.unpersist()
