"""The enrichment stream against its batch form."""

import pytest
from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.operators import sales
from tidemark.plans import stream_queries
from tidemark.sources.streams import file_stream
from tidemark.streaming import sale_stream

T0 = 1_700_000_000


def _messages(spark, rows):
    """(minute written, row JSON) -> at, value, seq, pos."""
    df = spark.createDataFrame([(T0 + 60 * m, i, v) for i, (m, v) in enumerate(rows)], "s long, seq long, v string")
    return df.select(F.timestamp_seconds("s").alias("at"), F.parse_json("v").alias("value"), "seq", F.lit(0).alias("pos"))


def _images(spark):
    rows = [("user_info", "5", '{"name":"u"}'), ("sku_info", "7", '{"name":"s","brand":"b"}')]
    return spark.createDataFrame(rows, "dim_table string, pk string, v string").withColumn("value", F.parse_json("v"))


def _line(order, no, sku=7):
    return f'{{"order_id":{order},"line_no":{no},"sku_id":{sku},"price":1.5}}'


def _order(key, user=5):
    return f'{{"id":{key},"user_id":{user},"day":"2024-01-01"}}'


def _run(spark, base, lines, orders, images, batches, **kw):
    """Run the stream over (lines, orders) micro-batches, restarted after each."""
    frames = {"lines": _messages(spark, lines), "orders": _messages(spark, orders)}
    for upto, since in zip(batches[1:], batches):
        for name, df in frames.items():
            part = df.where((F.unix_seconds("at") >= T0 + 60 * since) & (F.unix_seconds("at") < T0 + 60 * upto))
            part.coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        streams = [file_stream(spark, f"{base}/{name}", df.schema) for name, df in frames.items()]
        sinks.await_all([sale_stream.start(*streams, images, f"{base}/out", f"{base}/ck", query_name=None, **kw)])
    return sorted((tuple(r) for r in spark.read.parquet(f"{base}/out").collect()), key=str)


def test_orders_before_after_missing_and_repeated(spark, tmp_path):
    lines = [(1, _line(1, 1)), (1, _line(2, 1)), (30, _line(1, 2)), (31, _line(3, 1, 8)), (31, _line(3, 1, 8)), (32, _line(4, 1))]
    orders = [(0, _order(1)), (33, _order(1)), (25, _order(2)), (40, _order(3, 6))]
    closing = [(5000, _line(-1, 0)), (5001, _line(-1, 0))], [(5000, _order(-2)), (5001, _order(-3))]
    got = _run(spark, tmp_path, lines + closing[0], orders + closing[1], _images(spark), (0, 20, 35, 60, 5001, 9000))
    want = sales.enriched(_messages(spark, lines), _messages(spark, orders), _images(spark))
    assert got == sorted((tuple(r) for r in want.collect()), key=str)
    assert sum(r[3] is None for r in got) == 1  # order 4 never came


def test_a_line_meets_orders_within_reach(spark, tmp_path):
    lines = [(100, _line(1, 1)), (100, _line(2, 1)), (5000, _line(-1, 0)), (5001, _line(-1, 0))]
    orders = [(110, _order(1)), (111, _order(2)), (5000, _order(-2)), (5001, _order(-3))]
    got = _run(spark, tmp_path, lines, orders, _images(spark), (0, 200, 5001, 9000), delay_minutes=20, reach_minutes=10)
    assert [(r[0], r[3]) for r in got] == [(1, 5), (2, None)]
    with pytest.raises(ValueError):
        sale_stream.enriched_stream(None, None, None, delay_minutes=19, reach_minutes=10)


def test_a_hot_order_is_spread(spark, tmp_path):
    lines = [(1, _line(1, n)) for n in range(3000)] + [(5000, _line(-1, 0)), (5001, _line(-1, 0))]
    orders = [(2, _order(1)), (5000, _order(-2)), (5001, _order(-3))]
    got = _run(spark, tmp_path, lines, orders, _images(spark), (0, 100), salt=4)
    assert len(got) == 3000 and {r[3] for r in got} == {5}
    state = spark.read.format("statestore").option("joinSide", "left").load(f"{tmp_path}/ck")
    assert state.select("partition_id").distinct().count() > 1


def test_parts_are_written_once_and_run_once(spark, small, monkeypatch):
    runs, usual = [], sinks.await_all
    monkeypatch.setattr(stream_queries.sinks, "await_all", lambda queries: (usual(queries), runs.extend(len(q.recentProgress) for q in queries))[0])
    monkeypatch.setattr(stream_queries, "_arrive", lambda *_: pytest.fail("a part is written again"))
    before = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled", None)
    got = stream_queries.q_sale_enriched_stream(spark, small)
    assert runs == [1] * (stream_queries.SALE_PARTS + 3)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled", None) == before
    assert got.count() == spark.read.parquet(f"{small}/lineitem.parquet").count()


def test_a_part_is_released_with_its_rows(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("part")).repartition(4)
    dealt = stream_queries._dealt(rows, f"{tmp_path}/dealt")
    for part in (0, 2, 5):  # there is no part 5
        stream_queries._released(spark, f"{tmp_path}/dealt", part, f"{tmp_path}/source")
    got = spark.read.schema(dealt.drop("part").schema).parquet(f"{tmp_path}/source")
    assert sorted(r.id for r in got.collect()) == [i for i in range(100) if i % 3 != 1]
