"""Sinks, sources and option builders."""

import io
import json
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from helpers import SMALL
from tidemark import sinks
from tidemark.operators import serving
from tidemark.plans import dau_queries
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.streams import kafka_options, offsets_json


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dau_table_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "dau")
    sinks.dau_table(dau_queries.dau_table(spark, SMALL), path)
    stored = serving.dau_scan(spark, path, "2024-01-15")
    assert stored.count() == 8
    plan = _plan(stored)
    assert "PartitionFilters" in plan and "2024-01-15" in plan
    again = sinks.read_dau_table(spark, path)
    assert dict(again.dtypes)["dt"] == "string"
    assert again.count() == 234


def test_topic_fanout_file_form(spark, tmp_path):
    df = spark.createDataFrame([("DWD_A_I", "{}"), ("DWD_A_I", "{}"), ("DWD_B_D", "{}")],
                               "topic string, value string")
    path = str(tmp_path / "topics")
    sinks.topic_fanout(df, path=path)
    back = spark.read.parquet(path)
    got = {r.topic: r.n for r in back.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert got == {"DWD_A_I": 2, "DWD_B_D": 1}


def test_kafka_and_jdbc_options():
    assert json.loads(offsets_json("t", {1: 5, 0: 42})) == {"t": {"0": 42, "1": 5}}
    o = kafka_options("ODS", "b:9092", "g", None)
    assert o["startingOffsets"] == "latest" and o["subscribe"] == "ODS"
    o = kafka_options("ODS", "b:9092", "g", {0: 7}, max_per_trigger=1000)
    assert json.loads(o["startingOffsets"]) == {"ODS": {"0": 7}}
    assert o["maxOffsetsPerTrigger"] == "1000"
    j = jdbc_options("jdbc:x://h/db", "user_info", user="u", password="p")
    assert j["dbtable"] == "user_info" and j["fetchsize"] == "10000"


def test_observe_counts(spark):
    from tidemark.operators import dau

    facts = dau_queries.dau_facts(spark, SMALL)
    before, obs_in = dau.observe(facts, "before")
    after, obs_out = dau.observe(dau.dedup(before), "after")
    after.write.format("noop").mode("overwrite").save()
    assert obs_in.get["rows"] == 346
    assert obs_out.get["rows"] == 234


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "dau")
    dau = dau_queries.dau_table(spark, SMALL)
    sinks.dau_table(dau, path)
    one_day = dau.where(F.col("dt") == "2024-01-15")
    sinks.dau_table(one_day, path, mode="upsert")
    sinks.dau_table(one_day, path, mode="upsert")
    back = sinks.read_dau_table(spark, path)
    assert back.count() == 234
    assert back.where(F.col("dt") == "2024-01-15").count() == 8


def test_upsert_keeps_devices_that_a_batch_lacks(spark, tmp_path):
    path = str(tmp_path / "dau")

    def rows(*mids):
        return spark.createDataFrame([(m, "u", "a", "c", "v", "2024-01-01", "08", ts) for m, ts in mids],
                                     "mid string, uid string, ar string, ch string, vc string, dt string, hr string, ts long")

    sinks.dau_table(rows(("a", 5), ("b", 5), ("c", 5)), path, mode="upsert")
    sinks.dau_table(rows(("d", 7), ("a", 3), ("b", 9)), path, mode="upsert")
    got = {r.mid: r.ts for r in sinks.read_dau_table(spark, path).collect()}
    assert got == {"a": 3, "b": 5, "c": 5, "d": 7}


def test_serving_defaults_to_today_and_rejects_bad_days(spark):
    import datetime as _dt

    import pytest

    dau = dau_queries.dau_table(spark, SMALL)
    today = _dt.datetime.now(_dt.timezone.utc).date().isoformat()
    assert serving.resolve_day(None) == today
    assert serving.dau_hour_count(dau).count() == 0          # the fixture holds January 2024 only
    assert serving.hourly_compare(dau).count() == 24
    with pytest.raises(ValueError):
        serving.realtime_hour(dau, "2020-13-01")
    assert serving.day_before("2020-03-01") == "2020-02-29"
    assert [tuple(r) for r in serving.dau_total(dau, "2024-01-15").collect()] == [("2024-01-15", 8)]
    assert [tuple(r) for r in serving.dau_total(dau, "2030-01-01").collect()] == [("2030-01-01", 0)]


def test_local_path_of_checkpoint_uris():
    from tidemark.session import _local_path

    assert _local_path("/tmp/a") == "/tmp/a"
    assert _local_path("file:/tmp/a") == "/tmp/a"
    assert _local_path("file:///tmp/a") == "/tmp/a"
    assert _local_path("hdfs://nn/ckpt") is None
    assert _local_path("s3a://bucket/ckpt") is None


def test_realtime_hour_response_document(spark):
    dau = dau_queries.dau_view(spark, SMALL, ("hr",))
    body = json.loads(serving.realtime_hour_response(dau, "2024-01-15").first().body)
    assert set(body) == {"today", "yesterday"}
    assert sum(body["today"].values()) == 8
    assert all(len(h) == 2 for h in body["today"])


def test_json_list_documents(spark):
    dau = dau_queries.dau_view(spark, SMALL, ("dt", "mid"))
    kpis = json.loads(serving.json_list(serving.realtime_total(dau, "2024-01-15"), ("id",)).first().body)
    assert [k["id"] for k in kpis] == ["dau", "new_mid"]
    assert kpis[0]["value"] == 8 and set(kpis[0]) == {"id", "name", "value"}
