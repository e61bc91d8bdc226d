"""Stores: dimension images, first-seen days, add-if-absent against a stored table."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.operators import cdc, sales
from tidemark.sinks import changelog, dim_store
from tidemark.streaming import jobs

LOG = "dim_table string, pk string, dim_key string, type string, seq long, pos long, value string"


def _variants(df):
    return df.withColumn("value", F.parse_json("value"))


def _log(spark, rows):
    return _variants(spark.createDataFrame([("sku_info", pk, f"DIM:SKU_INFO:{pk}", kind, seq, 0, f'"{value}"')
                                            for pk, kind, seq, value in rows], LOG))


def _images(spark, store, **kw):
    images = dim_store.read_images(spark, store, **kw).withColumn("value", F.col("value").cast("string"))
    return {r.pk: (r.type, r.seq, r.value) for r in images.collect()}


def _files(store):
    found = {}
    for at, _, names in os.walk(f"{store}/images"):
        if "bucket=" in at:
            found[int(at.rsplit("=", 1)[1])] = {n for n in names if n.endswith(".parquet")}
    return found


def test_compaction_in_parts_equals_the_latest_images(spark, tmp_path):
    log, store = f"{tmp_path}/change log", f"{tmp_path}/store"
    first = [("1", "INSERT", 10, "a"), ("2", "INSERT", 20, "b"), ("3", "DELETE", 40, "c")]
    later = [("1", "UPDATE", 11, "a2"), ("3", "UPDATE", 30, "old"), ("4", "INSERT", 50, "d"), ("4", "INSERT", 50, "d")]
    changelog(_log(spark, first), log)
    assert dim_store.compact(spark, log, store)
    files = _files(store)
    assert dim_store.compact(spark, log, store) == [] and _files(store) == files  # no new file, nothing rewritten
    changelog(_log(spark, later), log)
    touched = dim_store.compact(spark, log, store)
    after = _files(store)
    # Only touched buckets have new files.
    assert {b for b in after if after[b] != files.get(b)} == set(touched) and set(files) - set(touched)
    got = _images(spark, store)
    assert got == {"1": ("UPDATE", 11, "a2"), "2": ("INSERT", 20, "b"), "3": ("DELETE", 40, "c"), "4": ("INSERT", 50, "d")}
    whole = cdc.dim_latest(_log(spark, first + later)).withColumn("value", F.col("value").cast("string")).collect()
    assert got == {r.pk: (r.type, r.seq, r.value) for r in whole}
    assert set(_images(spark, store, deletes="apply")) == {"1", "2", "4"}


def test_a_failed_merge_is_made_up_for(spark, tmp_path, monkeypatch):
    log, store = f"{tmp_path}/log", f"{tmp_path}/store"
    changelog(_log(spark, [("1", "INSERT", 1, "a")]), log)
    with pytest.raises(FileNotFoundError):
        dim_store.read_images(spark, store)

    def fail(*a):
        raise OSError("lost")
    for value, seq in (("a", 1), ("b", 2)):
        changelog(_log(spark, [("1", "UPDATE", seq, value), (f"n{seq}", "INSERT", seq, "n")]), log)
        with monkeypatch.context() as m:  # the stream has taken the files, but nothing was merged
            m.setattr(dim_store, "overwrite_partitions", fail)
            with pytest.raises(OSError):
                dim_store.compact(spark, log, store)
        if seq == 1:
            assert dim_store.compact(spark, log, store)
    assert dim_store.compact(spark, log, store)
    assert _images(spark, store) == {"1": ("UPDATE", 2, "b"), "n1": ("INSERT", 1, "n"), "n2": ("INSERT", 2, "n")}


def test_compact_job_over_the_routers_folder(spark, tmp_path):
    env = spark.createDataFrame([
        (1, '{"table":"sku_info","type":"INSERT","pkNames":["id"],"data":[{"id":1,"name":"x"},{"id":2,"name":"y"}]}'),
        (2, '{"table":"order_info","type":"INSERT","pkNames":["id"],"data":[{"id":9}]}')], "seq long, value string")
    cdc.route_all(cdc.valid(cdc.parse(env))).write.partitionBy("route").parquet(f"{tmp_path}/routed")
    args = jobs.parser().parse_args(["compact", "--dim-log", f"{tmp_path}/routed", "--store", f"{tmp_path}/store"])
    jobs.compact_job(spark, args)
    assert set(_images(spark, f"{tmp_path}/store")) == {"1", "2"}


def test_an_older_image_in_a_higher_partition_loses(spark):
    rows = [("2024-01-01 00:00:00", 3, 100, "old"), ("2024-01-02 00:00:00", 0, 5, "new")]
    log = spark.createDataFrame([("t", "1", "k", "UPDATE", *r) for r in rows],
                                "dim_table string, pk string, dim_key string, type string, at string, "
                                "partition int, offset long, value string")
    log = log.withColumn("seq", F.struct(F.col("at").cast("timestamp").alias("timestamp"), "partition", "offset")) \
             .withColumn("pos", F.lit(0))
    assert [r.value for r in cdc.dim_latest(log).collect()] == ["new"]


DAU = "mid string, uid string, ar string, ch string, vc string, dt string, hr string, ts long"


def _dau(spark, *rows):
    return spark.createDataFrame([(mid, None, None, None, None, dt, "00", ts) for mid, dt, ts in rows], DAU)


def test_first_seen_in_any_order_of_days(spark, tmp_path):
    path = f"{tmp_path}/first"
    sinks.first_seen_table(_dau(spark, ("a", "2024-01-03", 1), ("b", "2024-01-03", 1)), path)
    sinks.first_seen_table(_dau(spark, ("a", "2024-01-01", 1), ("c", "2024-01-02", 1)), path)
    sinks.first_seen_table(_dau(spark, ("a", "2024-01-05", 1), ("b", "2024-01-03", 1)), path)
    got = {tuple(r) for r in sinks.read_first_seen(spark, path).collect()}
    assert got == {("a", "2024-01-01"), ("b", "2024-01-03"), ("c", "2024-01-02")}
    # The last device leaves a day, another day is not touched.
    kept = set(os.listdir(f"{path}/first_dt=2024-01-01"))
    sinks.first_seen_table(_dau(spark, ("b", "2023-12-30", 1)), path)
    got = {tuple(r) for r in sinks.read_first_seen(spark, path).collect()}
    assert got == {("a", "2024-01-01"), ("b", "2023-12-30"), ("c", "2024-01-02")}
    assert set(os.listdir(f"{path}/first_dt=2024-01-01")) == kept


def test_add_absent_against_a_stored_table(spark, tmp_path):
    path = f"{tmp_path}/dau"
    batch = _dau(spark, ("a", "2024-01-01", 9), ("b", "2024-01-01", 8), ("b", "2024-01-01", 7), ("a", "2024-01-02", 6))
    assert len(sinks.add_absent(batch, path).collect()) == 3  # no table yet
    sinks.dau_table(_dau(spark, ("a", "2024-01-01", 1), ("z", "2023-12-31", 1)), path)
    got = {(r.mid, r.dt, r.ts) for r in sinks.add_absent(batch, path).collect()}
    assert got == {("b", "2024-01-01", 7), ("a", "2024-01-02", 6)}
    assert sinks.add_absent(batch.limit(0), path).count() == 0


def test_a_line_without_order_or_image_keeps_its_row(spark):
    lines = spark.createDataFrame([('{"order_id":1,"line_no":1,"sku_id":7,"price":2.5}',),
                                   ('{"order_id":2,"line_no":1,"sku_id":8,"price":1.0}',)], "value string")
    lines = _variants(lines)
    orders = spark.createDataFrame([(1, 0, '{"id":1,"user_id":5,"day":"2024-01-01"}'),
                                    (1, 1, '{"id":1,"user_id":6,"day":"2024-01-02"}')], "seq long, pos long, value string")
    orders = _variants(orders)
    images = spark.createDataFrame([("user_info", "6", '{"id":6,"name":"u"}'),
                                    ("sku_info", "7", '{"id":7,"name":"s","brand":"b"}')],
                                   "dim_table string, pk string, value string")
    images = _variants(images)
    got = sorted(tuple(r) for r in sales.enriched(lines, orders, images).collect())
    assert got == [(1, 1, 2.5, 6, "2024-01-02", "u", 7, "s", "b"), (2, 1, 1.0, None, None, None, 8, None, None)]
