"""Streaming twins equal their batch results, also across a restart."""

import glob
import io
import os
import shutil
import time
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from helpers import SMALL
from tidemark import sinks
from tidemark.plans import dau_queries
from tidemark.sources.adapters import raw_log_from
from tidemark.sources.streams import file_stream
from tidemark.sources.tables import read_table
from tidemark.streaming import dau_stream, progress


def _texts(rows):
    return rows.withColumn("value", F.to_json("value"))


def _split_events(spark, tmp_path):
    """events cut in three time slices, one parquet file each."""
    ev = read_table(spark, SMALL, "events")
    ts = F.col("ts")
    cuts = [F.lit("2024-01-11").cast("timestamp_ntz"), F.lit("2024-01-21").cast("timestamp_ntz")]
    slices = [ev.where(ts < cuts[0]), ev.where((ts >= cuts[0]) & (ts < cuts[1])), ev.where(ts >= cuts[1])]
    files = []
    for i, s in enumerate(slices):
        out = str(tmp_path / f"stage{i}")
        s.coalesce(1).write.parquet(out)
        files.append(glob.glob(os.path.join(out, "*.parquet"))[0])
    return ev.schema, files


def _drop_in(files, src, names):
    """Copy files in with strictly increasing modification times (= arrival order)."""
    os.makedirs(src, exist_ok=True)
    base = time.time() + 10 * len(os.listdir(src))
    for i, (f, n) in enumerate(zip(files, names)):
        dst = os.path.join(src, n)
        shutil.copy(f, dst)
        os.utime(dst, (base + i, base + i))


def test_dau_stream_restart_equals_batch(spark, tmp_path):
    schema, files = _split_events(spark, tmp_path)
    src, table, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    # Unordered arrival: middle slice, then the last, then (after a restart) the first.
    _drop_in([files[1], files[2]], src, ["a.parquet", "b.parquet"])

    def run():
        raw = raw_log_from(file_stream(spark, src, schema, max_files_per_trigger=1))
        q = dau_stream.start(raw, table, ckpt, delay="40 days", query_name=None)
        sinks.await_all([q])
        return q

    q1 = run()
    assert len(progress.batch_offsets(q1)) >= 2
    seen = [m for m in progress.observed(q1) if "dau_in" in m]
    assert seen and all(m["dau_out"]["rows"] <= m["dau_in"]["rows"] for m in seen)
    first_pass = sinks.read_dau_table(spark, table).count()
    _drop_in([files[0]], src, ["c.parquet"])
    q2 = run()
    assert progress.dropped_late_rows(q2) == 0

    got = sinks.read_dau_table(spark, table, columns=("mid", "dt"))
    expect = dau_queries.dau_table(spark, SMALL).select("dt", "mid")
    assert got.count() == expect.count() == 234
    assert got.select("dt", "mid").subtract(expect).count() == 0
    assert first_pass < 234
    # The dashboard's day scan over the streamed table: committed files only, one partition read.
    from tidemark.operators import serving

    day = serving.dau_scan(spark, table, "2024-01-15")
    assert day.count() == 8
    buf = io.StringIO()
    with redirect_stdout(buf):
        day.explain()
    assert "PartitionFilters: [isnotnull(dt" in buf.getvalue()


def test_short_watermark_never_counts_twice(spark, tmp_path):
    """A replay of old days after the watermark moved on is dropped, not re-counted."""
    schema, files = _split_events(spark, tmp_path)
    src, table, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    # last slice, first slice, then the first slice again (a replay).
    _drop_in([files[2], files[0], files[0]], src, ["a.parquet", "b.parquet", "c.parquet"])
    raw = raw_log_from(file_stream(spark, src, schema, max_files_per_trigger=1))
    q = dau_stream.start(raw, table, ckpt, delay="1 day", query_name=None)
    sinks.await_all([q])
    got = sinks.read_dau_table(spark, table, columns=("mid", "dt"))
    assert got.count() == got.distinct().count()
    # Spark filters late rows against the previous batch's watermark, so the
    # first slice (batch 1) is still accepted once; its replay (batch 2) is not.
    batches = sorted(progress.batch_offsets(q), key=lambda b: b["batchId"])
    assert [b["numInputRows"] for b in batches][:3] == [302, 344, 344]
    expect = dau_queries.dau_table(spark, SMALL).where(
        (F.col("dt") < "2024-01-11") | (F.col("dt") >= "2024-01-21"))
    assert got.count() == expect.count()


def test_jobs_cli_file_source(spark, tmp_path):
    """The DAU and CDC jobs run end to end over JSON-lines files."""
    from tidemark.plans import cdc_queries
    from tidemark.sources.adapters import cdc_raw, raw_log
    from tidemark.streaming import jobs

    logs_dir, cdc_dir = str(tmp_path / "logs"), str(tmp_path / "cdc")
    raw_log(spark, SMALL).select("value").write.json(logs_dir)
    cdc_raw(spark, SMALL).select("seq", "value").write.json(cdc_dir)

    args = jobs.parser().parse_args([
        "dau", "--source", "file", "--source-path", logs_dir, "--table", str(tmp_path / "dau"),
        "--checkpoint", str(tmp_path / "ck1"), "--trigger", "availableNow", "--replay"])
    sinks.await_all(jobs.dau_job(spark, args))
    assert sinks.read_dau_table(spark, str(tmp_path / "dau")).count() == 234

    args = jobs.parser().parse_args([
        "cdc", "--source", "file", "--source-path", cdc_dir, "--dim-log", str(tmp_path / "dims"),
        "--facts", str(tmp_path / "facts"), "--checkpoint", str(tmp_path / "ck2"),
        "--trigger", "availableNow", "--two-queries"])
    sinks.await_all(jobs.cdc_job(spark, args))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    assert facts.count() == cdc_queries.fact_messages(spark, SMALL).count()

    from tidemark.operators import cdc
    from tidemark.streaming import cdc_stream

    args = jobs.parser().parse_args([
        "cdc", "--source", "file", "--source-path", cdc_dir, "--facts", str(tmp_path / "routed"),
        "--checkpoint", str(tmp_path / "ck3"), "--trigger", "availableNow"])
    sinks.await_all(jobs.cdc_job(spark, args))
    routed = cdc_stream.read_routed(spark, str(tmp_path / "routed"))
    assert cdc.facts_of(routed).count() == facts.count()
    latest = cdc.dim_latest(cdc.dim_log_of(routed))
    expect = cdc.dim_latest(cdc_queries.dim_log(spark, SMALL))
    cols = ["dim_key", "seq", "type", "value"]
    assert _texts(latest).select(*cols).exceptAll(_texts(expect).select(*cols)).count() == 0
    assert latest.count() == expect.count()


def test_cdc_router_restart_equals_batch(spark, tmp_path):
    """One-pass router over a change log split in two files, restarted between them."""
    from tidemark.operators import cdc
    from tidemark.plans import cdc_queries
    from tidemark.sources.adapters import cdc_raw
    from tidemark.streaming import cdc_stream

    log = cdc_raw(spark, SMALL)
    stage = [str(tmp_path / "stage_a"), str(tmp_path / "stage_b")]
    # Later changes first: the second file holds the earlier half of the log.
    log.where(F.col("seq") >= 20000).coalesce(1).write.parquet(stage[0])
    log.where(F.col("seq") < 20000).coalesce(1).write.parquet(stage[1])
    files = [glob.glob(os.path.join(s, "*.parquet"))[0] for s in stage]
    schema = spark.read.parquet(stage[0]).schema
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "routed"), str(tmp_path / "ckpt")

    def run():
        q = cdc_stream.start_single(file_stream(spark, src, schema), out, ckpt, query_name=None)
        sinks.await_all([q])

    _drop_in([files[0]], src, ["a.parquet"])
    run()
    _drop_in([files[1]], src, ["b.parquet"])
    run()

    routed = cdc_stream.read_routed(spark, out)
    batch = cdc.route_all(cdc_queries.parsed_changes(spark, SMALL))
    cols = ["route", "seq", "pos", "dim_key", "value"]
    assert routed.count() == batch.count()
    assert _texts(routed).select(*cols).exceptAll(_texts(batch).select(*cols)).count() == 0
    # Out-of-order arrival does not change the latest images: order is by seq, not arrival.
    got = _texts(cdc.dim_latest(cdc.dim_log_of(routed))).select("dim_key", "seq", "value")
    expect = _texts(cdc.dim_latest(cdc_queries.dim_log(spark, SMALL))).select("dim_key", "seq", "value")
    assert got.exceptAll(expect).count() == 0 and got.count() == expect.count()


def test_dau_stream_sink_partitions_bounds_files(spark, tmp_path):
    schema, files = _split_events(spark, tmp_path)
    src, table, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    _drop_in(files, src, ["a.parquet", "b.parquet", "c.parquet"])
    raw = raw_log_from(file_stream(spark, src, schema))
    q = dau_stream.start(raw, table, ckpt, query_name=None, sink_partitions=2)
    sinks.await_all([q])
    day_files = glob.glob(os.path.join(table, "dt=2024-01-15", "*.parquet"))
    assert 1 <= len(day_files) <= 2
    assert sinks.read_dau_table(spark, table).count() == 234


def test_cdc_batch_fan_out(spark, tmp_path):
    """Batch form of the two arms: parsed once (persisted), written twice."""
    from tidemark.operators import cdc
    from tidemark.plans import cdc_queries
    from tidemark.sources.adapters import cdc_raw
    from tidemark.streaming import cdc_stream

    dims, facts = str(tmp_path / "dims"), str(tmp_path / "facts")
    cdc_stream.run_batch(cdc_raw(spark, SMALL), dims, facts)
    assert spark.read.parquet(facts).count() == cdc_queries.fact_messages(spark, SMALL).count()
    got = cdc.dim_latest(spark.read.parquet(dims)).count()
    assert got == cdc.dim_latest(cdc_queries.dim_log(spark, SMALL)).count()
    assert not spark.sparkContext._jsc.getPersistentRDDs()      # released after the writes


def test_snapshot_publish_round_trip(spark, tmp_path):
    """Bootstrap snapshot -> change topic folder -> router: every dimension row keyed once."""
    from tidemark.operators import cdc
    from tidemark.sources.adapters import dimension_tables
    from tidemark.streaming import jobs

    out = str(tmp_path / "topics")
    tables = dimension_tables(spark, SMALL)
    jobs.publish_snapshot(tables, "ODS_BASE_DB_C", out=out)
    msgs = spark.read.parquet(out)
    assert {r.topic for r in msgs.select("topic").distinct().collect()} == {"ODS_BASE_DB_C"}
    routed = cdc.route_all(cdc.valid(cdc.parse(msgs.select("value"))))
    dims = cdc.dim_log_of(routed)
    assert dims.count() == sum(t.count() for t in tables.values())
    assert dims.select("dim_key").distinct().count() == dims.count()


def test_jobs_main_as_a_process(spark, tmp_path):
    """`python -m tidemark.streaming.jobs dau ...` runs to the end of its input in its own JVM."""
    import subprocess
    import sys

    from tidemark.sources.adapters import raw_log

    logs_dir = str(tmp_path / "logs")
    raw_log(spark, SMALL).select("value").write.json(logs_dir)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root + os.pathsep + os.environ.get("PYTHONPATH", ""))
    cmd = [sys.executable, "-m", "tidemark.streaming.jobs", "dau", "--source", "file",
           "--source-path", logs_dir, "--table", str(tmp_path / "dau"),
           "--checkpoint", str(tmp_path / "ck"), "--trigger", "availableNow", "--replay"]
    done = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    from tidemark.streaming import jobs
    assert jobs.parser().parse_args(cmd[3:]).spark_ui is False     # the job ran without the web UI
    assert sinks.read_dau_table(spark, str(tmp_path / "dau")).count() == 234
