"""Results stay exact when one key holds a third of all rows."""

import json


from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import MEDIUM
from tidemark import sinks
from tidemark.operators import cdc, dau, logs
from tidemark.sources.adapters import raw_log_from
from tidemark.sources.streams import file_stream
from tidemark.sources.tables import read_table
from tidemark.streaming import dau_stream

HOT = 424242


def _skewed_events(spark):
    """events with every third row moved to one device, over 8 input partitions."""
    ev = read_table(spark, MEDIUM, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id"))
    return ev.withColumn("user_id", hot.cast("bigint")).repartition(8)


def _facts(raw):
    return dau.to_fact(logs.session_starts(logs.prepared(raw)))


def test_dedup_exact_under_skew(spark):
    facts = _facts(raw_log_from(_skewed_events(spark)))
    got = dau.detail(dau.dedup(facts))
    w = Window.partitionBy("dt", "mid").orderBy("ts", "event_id")
    brute = dau.detail(facts.withColumn("rn", F.row_number().over(w)).where("rn = 1"))
    assert got.count() == brute.count()
    assert got.exceptAll(brute).count() == 0
    hot_days = got.where(F.col("mid") == str(HOT)).count()
    assert hot_days == 30


def test_stream_dedup_exact_under_skew(spark, tmp_path):
    src = str(tmp_path / "src")
    _skewed_events(spark).write.parquet(src)
    schema = spark.read.parquet(src).schema
    raw = raw_log_from(file_stream(spark, src, schema))
    q = dau_stream.start(raw, str(tmp_path / "t"), str(tmp_path / "c"), query_name=None)
    sinks.await_all([q])
    got = sinks.read_dau_table(spark, str(tmp_path / "t"), columns=("mid", "dt"))
    expect = dau.dedup(_facts(raw_log_from(spark.read.parquet(src)))).select("dt", "mid")
    assert got.count() == expect.count()
    assert got.select("dt", "mid").exceptAll(expect).count() == 0


def test_dim_latest_hot_key(spark):
    rows = spark.range(0, 30000, numPartitions=8).select(
        F.lit("user_info").alias("dim_table"),
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 1000).cast("string")).alias("pk"),
        F.col("id").alias("seq"), F.lit(0).cast("bigint").alias("pos"),
        F.lit("UPDATE").alias("type"), F.col("id").cast("string").alias("value"))
    rows = rows.withColumn("dim_key", F.concat(F.lit("DIM:USER_INFO:"), "pk"))
    latest = {r.pk: r for r in cdc.dim_latest(rows).collect()}
    assert latest["1"].seq == 29997
    assert len(latest) == 1000


def test_order_of_many_lines_has_unique_positions(spark, tmp_path):
    """1,500 copies of one line of one order: one message each, all (seq, pos) differ, no shuffle."""
    from tidemark.sources import adapters

    one = read_table(spark, MEDIUM, "lineitem").limit(1)
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(1500))).alias("_k")).drop("_k")
    copies.repartition(3).write.parquet(str(tmp_path / "lineitem"))
    env = adapters.order_detail_envelopes(spark.read.parquet(str(tmp_path / "lineitem")))
    assert "Exchange" not in env._jdf.queryExecution().executedPlan().toString()
    msgs = cdc.route_facts(cdc.valid(cdc.parse(env)))
    assert msgs.count() == msgs.select("seq", "pos").distinct().count() == 1500


def test_predup_keeps_first_row_per_key_and_batch(spark):
    rows = [("2024-01-01", "hot", i) for i in range(50)] + \
           [("2024-01-01", f"m{i % 5}", 100 + i) for i in range(20)] + [("2024-01-02", "hot", 200)]
    df = spark.createDataFrame(rows, "dt string, mid string, ts long").coalesce(1)
    want = [("2024-01-01", "hot", 0)] + [("2024-01-01", f"m{i}", 100 + i) for i in range(5)] + [("2024-01-02", "hot", 200)]
    assert [tuple(r) for r in dau_stream.predup_in_batches(df).collect()] == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")   # small batches let repeats through only
    try:
        assert {tuple(r)[:2] for r in dau_stream.predup_in_batches(df).collect()} == {w[:2] for w in want}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_aqe_splits_a_skewed_star_join(spark):
    """With shuffle joins forced and thresholds scaled to the fixture, AQE splits the hot key."""
    import io
    from contextlib import redirect_stdout

    from tidemark.operators import sales

    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        li = read_table(spark, MEDIUM, "lineitem")
        hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(1))
                            .otherwise(F.col("l_orderkey")))
        hot = hot.repartition(8)  # AQE splits by map task; the fixture's one row group is one
        w = sales.wide(hot, read_table(spark, MEDIUM, "orders"), read_table(spark, MEDIUM, "customer"),
                       read_table(spark, MEDIUM, "part"), read_table(spark, MEDIUM, "nation"))
        agg = w.agg(F.count(F.lit(1)).alias("n"))
        assert agg.collect()[0].n == 60000          # executes this plan, so explain shows the final one
        buf = io.StringIO()
        with redirect_stdout(buf):
            agg.explain()
        assert "isFinalPlan=true" in buf.getvalue() and "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
