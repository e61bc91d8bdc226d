"""Edge rows of FIXTURES.md §2.5 through the page-log and change-record operators."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, dau, logs
from tidemark.functions.schemas import CORRUPT

DAY_MS = 1704067200000  # 2024-01-01 00:00:00 UTC


def _log(spark, docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "event_id long, value string")


def test_parse_quarantine_and_types(spark):
    docs = [
        "{not json",                                                     # 0 bad JSON
        {"ts": str(DAY_MS + 1000), "common": {"mid": "a"}, "page": {}},  # 1 quoted ts
        {"common": {"mid": "b"}, "page": {}},                           # 2 missing ts
        {"ts": DAY_MS, "page": {}},                                      # 3 missing common
        {"ts": DAY_MS, "common": {"mid": 7}, "page": {}},               # 4 numeric mid
        "[1, 2]",                                                        # 5 not an object
    ]
    parsed = logs.parse(_log(spark, docs))
    good = {r.event_id: r for r in logs.valid(parsed).collect()}
    bad = {r.event_id for r in logs.quarantine(parsed).collect()}
    assert bad == {0, 2, 3, 5}
    assert {r.event_id: r.fault for r in logs.quarantine(parsed).collect()} == {0: "json", 2: "ts", 3: "common", 5: "json"}
    assert good[1].ts == DAY_MS + 1000
    assert good[4].common.mid == "7"
    row0 = logs.quarantine(parsed).where("event_id = 0").first()
    assert row0[CORRUPT] == "{not json"


def test_session_start_filter_branches(spark):
    docs = [
        {"ts": DAY_MS, "common": {"mid": "a"}},                                   # no page
        {"ts": DAY_MS, "common": {"mid": "a"}, "page": None},                     # page null
        {"ts": DAY_MS, "common": {"mid": "a"}, "page": {"last_page_id": None}},   # null id
        {"ts": DAY_MS, "common": {"mid": "a"}, "page": {"last_page_id": ""}},     # empty id
        {"ts": DAY_MS, "common": {"mid": "a"}, "page": {"last_page_id": "p1"}},   # set
        {"ts": DAY_MS, "common": {"mid": "a"}, "page": {}},                       # id missing
    ]
    starts = logs.session_starts(logs.prepared(_log(spark, docs)))
    assert sorted(r.event_id for r in starts.collect()) == [2, 3, 5]


def test_dt_hr_and_midnight_and_dedup_order(spark):
    docs = [
        {"ts": DAY_MS - 1, "common": {"mid": "m", "uid": "late-day"}, "page": {}},   # 2023-12-31 23h
        {"ts": DAY_MS + 5, "common": {"mid": "m", "uid": "second"}, "page": {}},
        {"ts": DAY_MS + 1, "common": {"mid": "m", "uid": "first"}, "page": {}},
        {"ts": DAY_MS + 1, "common": {"mid": "m", "uid": "tie-later-id"}, "page": {}},
        {"ts": DAY_MS + 3600_000 * 5, "common": {"mid": None}, "page": {}},          # no device
    ]
    facts = dau.to_fact(logs.session_starts(logs.prepared(_log(spark, docs))))
    out = {(r.dt, r.mid): r for r in dau.detail(dau.dedup(facts)).collect()}
    assert set(out) == {("2023-12-31", "m"), ("2024-01-01", "m")}
    assert out[("2024-01-01", "m")].uid == "first"
    assert out[("2024-01-01", "m")].hr == "00"
    assert out[("2023-12-31", "m")].hr == "23"


def test_incremental_is_add_if_absent(spark):
    docs = [{"ts": DAY_MS + i, "common": {"mid": m}, "page": {}} for i, m in enumerate("abc")]
    facts = dau.to_fact(logs.session_starts(logs.prepared(_log(spark, docs))))
    stored = dau.dedup(facts.where(F.col("mid") == "a"))
    inc = dau.incremental(facts, stored)
    assert sorted(r.mid for r in inc.collect()) == ["b", "c"]


def _cdc(spark, docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_cdc_edges(spark):
    docs = [
        {"table": "order_info", "type": "INSERT", "data": [{"id": 1}, {"id": 2}]},   # 0 two rows
        {"table": "order_info", "type": "QUERY", "data": [{"id": 3}]},               # 1 dropped
        {"table": "order_info", "type": "UPDATE", "data": []},                        # 2 empty data
        {"table": "order_info", "type": "DELETE", "data": None},                      # 3 null data
        {"table": None, "type": "INSERT", "data": [{"id": 4}]},                       # 4 null table
        {"table": "user_info", "type": "INSERT", "pkNames": None, "data": [{"id": 5}]},  # 5 no pk
        {"table": "user_info", "type": "INSERT", "pkNames": [], "data": [{"id": 6}]},    # 6 empty pk
        {"table": "user_info", "type": "INSERT", "pkNames": ["id"], "data": [{"id": None, "n": "x"}]},  # 7
        {"table": "user_info", "type": "INSERT", "pkNames": ["id"],
         "data": [{"id": 8, "n": "old"}, {"id": 8, "n": "new"}]},                       # 8 two images
        {"table": "user_info", "type": "DELETE", "pkNames": ["id"], "data": [{"id": 9, "n": "gone"}]},
        "garbage",
    ]
    parsed = cdc.parse(_cdc(spark, docs))
    assert [r.seq for r in cdc.quarantine(parsed).collect()] == [10]
    dims, facts = cdc.split(cdc.valid(parsed))
    routed = _texts(cdc.route_facts(facts)).collect()
    assert sorted((r.topic, json.loads(r.value)["id"]) for r in routed) == [
        ("DWD_ORDER_INFO_I", 1), ("DWD_ORDER_INFO_I", 2)]
    assert sorted(r.seq for r in cdc.dim_rows_rejected(dims).collect()) == [5, 6]
    log = cdc.dim_rows(dims)
    latest = {r.dim_key: r for r in _texts(cdc.dim_latest(log)).collect()}
    assert set(latest) == {"DIM:USER_INFO:8", "DIM:USER_INFO:9"}
    assert json.loads(latest["DIM:USER_INFO:8"].value)["n"] == "new"
    applied = {r.dim_key for r in cdc.dim_latest(log, deletes="apply").collect()}
    assert applied == {"DIM:USER_INFO:8"}


def _texts(rows):
    """Rows with their variant as text, as at a sink."""
    return rows.withColumn("value", cdc.as_text())


def test_cdc_full_key_and_numeric_pk(spark):
    docs = [{"table": "sku_info", "type": "INSERT", "pkNames": ["a", "b"],
             "data": [{"a": 1, "b": "x"}]}]
    dims, _ = cdc.split(cdc.valid(cdc.parse(_cdc(spark, docs))))
    assert cdc.dim_rows(dims).first().dim_key == "DIM:SKU_INFO:1"
    assert cdc.dim_rows(dims, full_key=True).first().dim_key == "DIM:SKU_INFO:1:x"


def test_full_keys_stay_different(spark):
    rows = [{"a": 1, "b": None}, {"a": None, "b": 1}, {"a": "x:y", "b": "z"}, {"a": "x", "b": "y:z"}, {"a": "x\\", "b": ":"}]
    docs = [{"table": "sku_info", "type": "INSERT", "pkNames": ["a", "b"], "data": rows}]
    parsed = cdc.valid(cdc.parse(_cdc(spark, docs)))
    dims, _ = cdc.split(parsed)
    want = ["DIM:SKU_INFO:x:y\\:z", "DIM:SKU_INFO:x\\:y:z", "DIM:SKU_INFO:x\\\\:\\:"]
    assert sorted(r.dim_key for r in cdc.dim_rows(dims, full_key=True).collect()) == sorted(want)
    assert sorted(r.dim_key for r in cdc.route_all(parsed, full_key=True).collect()) == sorted(want)


@pytest.mark.parametrize("name", ["a.b", "it's", 'a"b', "x]y", ""])
def test_odd_pk_names(spark, name):
    docs = [{"table": "sku_info", "type": "INSERT", "pkNames": [name], "data": [{name: 5}]}]
    dims, _ = cdc.split(cdc.valid(cdc.parse(_cdc(spark, docs))))
    assert cdc.dim_rows(dims).first().dim_key == "DIM:SKU_INFO:5"


def test_a_pk_name_with_both_quotes_cannot_be_looked_up(spark):
    docs = [{"table": "sku_info", "type": "INSERT", "pkNames": ["a'b\"c"], "data": [{"a'b\"c": 5}]}]
    parsed = cdc.parse(_cdc(spark, docs))
    assert cdc.route_all(cdc.valid(parsed)).count() == 0
    assert [r.fault for r in cdc.rejects(parsed).collect()] == ["pk"]


def test_payload_keeps_every_digit(spark):
    text = '{"table": "t", "type": "INSERT", "pkNames": null, "data": [{"m": 12345678901234567.89, "n": 98765432109876543210, "q": 0.1}]}'
    raw = spark.createDataFrame([(1, text)], "seq long, value string")
    value = _texts(cdc.route_facts(cdc.valid(cdc.parse(raw)))).first().value
    assert value == '{"m":12345678901234567.89,"n":98765432109876543210,"q":0.1}'


def test_snapshot_messages_are_keyed(spark):
    env = cdc.snapshot_envelopes({"user_info": spark.createDataFrame([(7, "x")], "id long, name string")})
    assert [r.key for r in env.collect()] == ["DIM:USER_INFO:7"]


def test_null_messages_are_quarantined(spark):
    logs_df = spark.createDataFrame([(1, None), (2, '{"ts": 1, "common": {}, "page": {}}')], "event_id long, value string")
    assert [r.event_id for r in logs.quarantine(logs.parse(logs_df)).collect()] == [1]
    cdc_df = spark.createDataFrame([(1, None), (2, '{"table": "t", "type": "INSERT", "data": []}')],
                                   "seq long, value string")
    bad = cdc.quarantine(cdc.parse(cdc_df)).collect()
    assert [(r.seq, r[CORRUPT]) for r in bad] == [(1, "")]


def test_op_code_and_topic(spark):
    df = spark.createDataFrame([("INSERT",), ("UPDATE",), ("DELETE",), ("ALTER",), (None,)], "t string")
    got = [r.c for r in df.select(cdc.op_code(F.col("t")).alias("c")).collect()]
    assert got == ["I", "U", "D", None, None]


def test_merge_latest_equals_full_latest(spark):
    from helpers import SMALL
    from tidemark.plans import cdc_queries

    log = cdc_queries.dim_log(spark, SMALL)
    first = log.where(F.col("seq") % 10 == 2)            # the insert images
    later = log.where(F.col("seq") % 10 != 2)            # updates, deletes, other tables
    snap = cdc.merge_latest(None, first)
    merged = cdc.merge_latest(snap, later)
    full = cdc.dim_latest(log)
    cols = ["dim_table", "pk", "seq", "type", "value"]
    assert _texts(merged).select(*cols).exceptAll(_texts(full).select(*cols)).count() == 0
    assert merged.count() == full.count()


def test_keyset_page_equals_offset_page(spark):
    from helpers import SMALL
    from tidemark.operators import sales
    from tidemark.plans import sales_queries

    rows = sales_queries.wide_rows(spark, SMALL)
    first = sales.detail_page(rows, 0, 7).collect()
    second_offset = sales.detail_page(rows, 7, 7).collect()
    second_seek = sales.detail_page_after(rows, tuple(first[-1]), 7).collect()
    assert [tuple(r) for r in second_seek] == [tuple(r) for r in second_offset]


def test_route_all_equals_separate_arms(spark):
    docs = [
        {"table": "order_info", "type": "INSERT", "data": [{"id": 1}, {"id": 2}]},
        {"table": "order_info", "type": "QUERY", "data": [{"id": 3}]},
        {"table": None, "type": "INSERT", "data": [{"id": 4}]},
        {"table": "order_info", "type": "UPDATE", "pkNames": ["id"], "data": [{"id": 11}]},
        {"table": "user_info", "type": "INSERT", "pkNames": None, "data": [{"id": 5}]},
        {"table": "user_info", "type": "INSERT", "pkNames": [], "data": [{"id": 6}]},
        {"table": "user_info", "type": "INSERT", "pkNames": ["id"], "data": [{"id": None}]},
        {"table": "user_info", "type": "DELETE", "pkNames": ["id"], "data": [{"id": 9, "n": "x"}]},
        {"table": "sku_info", "type": "ALTER", "pkNames": ["id"], "data": [{"id": 10}]},
    ]
    parsed = cdc.valid(cdc.parse(_cdc(spark, docs)))
    routed = _texts(cdc.route_all(parsed))
    dims, facts = cdc.split(parsed)
    cols = ["seq", "dim_table", "pk", "dim_key", "type", "pos", "value"]
    assert sorted(map(tuple, cdc.dim_log_of(routed).select(*cols).collect())) == \
        sorted(map(tuple, _texts(cdc.dim_rows(dims)).select(*cols).collect()))
    fcols = ["seq", "topic", "pos", "value"]
    assert sorted(map(tuple, cdc.facts_of(routed).select(*fcols).collect())) == \
        sorted(map(tuple, _texts(cdc.route_facts(facts)).select(*fcols).collect()))
    assert {r.route for r in routed.collect()} == {"DWD_ORDER_INFO_I", "DWD_ORDER_INFO_U", "DIM_USER_INFO",
                                                    "DIM_SKU_INFO"}
    keys = {(r.route, r.msg_key) for r in routed.collect()}
    assert ("DIM_USER_INFO", "DIM:USER_INFO:9") in keys
    assert ("DWD_ORDER_INFO_I", None) in keys       # no pkNames on that envelope: unkeyed
    assert ("DWD_ORDER_INFO_U", "11") in keys        # keyed by its own pk


def test_dim_rows_counts_what_it_leaves_out(spark):
    from pyspark.sql import Observation

    docs = [
        {"table": "user_info", "type": "INSERT", "pkNames": None, "data": [{"id": 5}, {"id": 55}]},
        {"table": "user_info", "type": "INSERT", "pkNames": [], "data": [{"id": 6}]},
        {"table": "user_info", "type": "INSERT", "pkNames": ["id"], "data": [{"id": None}, {"id": 7}]},
    ]
    dims, _ = cdc.split(cdc.valid(cdc.parse(_cdc(spark, docs))))
    obs = Observation("dim_drops")
    kept = cdc.dim_rows(dims, observation=obs).collect()
    assert [r.pk for r in kept] == ["7"]
    assert obs.get == {"no_pk_names": 2, "empty_pk_names": 1, "null_pk": 1}
    assert cdc.dim_rows_null_pk(dims).count() == 1
    assert sorted(r.pk for r in cdc.dim_rows(dims).collect()) == ["7"]
