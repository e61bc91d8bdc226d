"""Maintained tables: rollups, device bitmaps, the bucketed day table, the search index, the ranged table."""

import io
import random
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import SMALL
from tidemark import sinks
from tidemark.operators import sales, search, search_index
from tidemark.plans import dau_queries, sales_queries
from tidemark.sinks import device_bitmaps, ranged_table, rollup_store
from tidemark.sources.tables import read_table


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


CHANGES = "row_key long, seq long, type string, amount decimal(18,2), shop string, name string, kind string"


def _changes(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHANGES)


def test_rollup_equals_full_recomputation(spark, tmp_path):
    rnd, path, seq = random.Random(2), f"{tmp_path}/rollup", 0
    latest, sent = {}, []
    for _ in range(4):
        batch = []
        for _ in range(120):
            seq += 1
            key = rnd.randrange(60)
            kind = rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
            row = (key, seq, kind, Decimal(rnd.randrange(-500, 10_000)) / 100, rnd.choice(["a", "b", None]), rnd.choice("xyz"))
            latest[key] = row
            batch.append(row)
        sent.append(batch)
        stale = [(k, 0, "UPDATE", Decimal("99.99"), "a", "x") for k in sorted(latest)[::7]]
        rnd.shuffle(batch)
        rollup_store.merge(_changes(spark, batch + stale), path, ["shop", "name"], buckets=5)
        # The same batch again, and the one before it, change nothing.
        for again in sent[-2:]:
            rollup_store.merge(_changes(spark, again), path, ["shop", "name"], buckets=5)
        live = [r for r in latest.values() if r[2] != "DELETE"]
        want = rollup_store.recomputed(_changes(spark, live), ["shop", "name"])
        assert sorted(map(str, rollup_store.read(spark, path, ["shop", "name"]).collect())) == sorted(map(str, want.collect()))


def test_rollup_rewrites_touched_buckets_only(spark, tmp_path):
    import os

    def files():
        return {d: set(os.listdir(f"{tmp_path}/r/{d}")) for d in os.listdir(f"{tmp_path}/r") if d.startswith("bucket=")}
    rows = [(k, 1, "INSERT", Decimal(1), "a", "x") for k in range(200)]
    rollup_store.merge(_changes(spark, rows), f"{tmp_path}/r", ["shop", "name"], buckets=8)
    before = files()
    (touched,) = rollup_store.merge(_changes(spark, [(3, 2, "DELETE", Decimal(1), "a", "x")]), f"{tmp_path}/r", ["shop", "name"], buckets=8)
    after = files()
    assert {d for d in after if after[d] != before[d]} == {f"bucket={touched}"}
    assert {(r.grouping, r.value, r.n) for r in rollup_store.read(spark, f"{tmp_path}/r", ["shop", "name"]).collect()} == \
        {("shop", "a", 199), ("name", "x", 199)}
    assert rollup_store.merge(_changes(spark, []), f"{tmp_path}/r", ["shop", "name"], buckets=8) == []


def test_a_hot_row_of_the_rollup_counts_once(spark, tmp_path):
    hot = spark.range(30_000).select(F.lit(7).cast("long").alias("row_key"), F.col("id").alias("seq"), F.lit("UPDATE").alias("type"),
                                     F.lit(2).alias("amount"), F.lit("a").alias("shop"), F.lit("x").alias("name"))
    rollup_store.merge(hot, f"{tmp_path}/r", ["shop", "name"])
    assert {(r.grouping, r.n, float(r.amount)) for r in rollup_store.read(spark, f"{tmp_path}/r", ["shop", "name"]).collect()} == \
        {("shop", 1, 2.0), ("name", 1, 2.0)}


DAU = "mid string, uid string, ar string, ch string, vc string, dt string, hr string, ts long"


def _dau(spark, pairs):
    return spark.createDataFrame([(m, None, None, None, None, d, "00", 1) for m, d in pairs], DAU)


def test_bitmaps_equal_sets(spark, tmp_path):
    rnd, path = random.Random(1), f"{tmp_path}/bits"
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    pairs = [(f"d{rnd.randrange(80)}", rnd.choice(days)) for _ in range(400)] + [(None, days[0])]
    for load in (pairs[200:], pairs[:250], pairs[100:300], []):
        device_bitmaps.merge(_dau(spark, load), path)
    numbers = device_bitmaps.devices(spark, path).collect()
    assert len({r.mid for r in numbers}) == len({r.id for r in numbers}) == len(numbers)
    for first, last in ((days[0], days[-1]), (days[3], days[5]), (days[9], days[9]), ("2025-01-01", "2025-01-02")):
        inside = {m for m, d in pairs if m and first <= d <= last}
        before = {m for m, d in pairs if m and d < first}
        got = device_bitmaps.active_over_days(spark, path, first, last).first()
        assert (got.active, got.returning, got.new) == (len(inside), len(inside & before), len(inside - before))


def test_absent_rows_without_shuffling_the_store(spark, tmp_path):
    path = f"{tmp_path}/dau"
    stored = [(f"m{i}", d) for i in range(50) for d in ("2024-01-01", "2024-01-02")]
    assert sinks.add_absent_bucketed(_dau(spark, stored), path).count() == 100  # no table yet
    sinks.append_bucketed(_dau(spark, stored[:60]), path, 4)
    sinks.append_bucketed(_dau(spark, stored[60:] + [("m1", "2024-01-03")]), path, 4)
    batch = [("m1", "2024-01-02"), ("m1", "2024-01-04"), ("new", "2024-01-01"), ("m2", "2024-01-03"), ("m2", "2024-01-03"), ("m1", "2024-01-03")]

    def absent():
        return sinks.add_absent_bucketed(_dau(spark, batch), path, 4)
    want = {("m1", "2024-01-04"), ("new", "2024-01-01"), ("m2", "2024-01-03")}
    assert {(r.mid, r.dt) for r in absent().collect()} == want
    plan = absent()._jdf.queryExecution().executedPlan().toString()
    stored_side = plan[plan.index("LeftAnti"):].split("Sort [_mid")[1]
    assert "Exchange" not in stored_side and "Bucketed: true" in stored_side and "PartitionFilters: [" in stored_side
    # A session that does not know the table learns of it from its folder.
    spark.sql(f"DROP TABLE {sinks._bucketed_name(path)}")
    assert {(r.mid, r.dt) for r in absent().collect()} == want


def test_index_equals_search(spark, tmp_path):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text", "lang", F.when(F.col("doc_id") % 9 != 0, F.col("n_chars")).alias("n_chars"))
    docs = docs.unionByName(spark.createDataFrame([(10 ** 6, None, "en", 5), (10 ** 6 + 1, "", "en", None), (10 ** 6 + 2, "LICENSE License", None, 9)], docs.schema))
    search_index.build(docs, f"{tmp_path}/ix", "text", "lang", "n_chars", "doc_id", buckets=7, head=30)
    for query in ("license tion", "the", "", "nowhere1", "Das die"):
        for term in ("en", "de", None):
            for start, size in ((0, 20), (25, 20), (0, 30)):
                got = search_index.find(spark, f"{tmp_path}/ix", query, term, start, size).select("doc_id").collect()
                want = search.find(docs, "text", query, "lang" if term else None, term, "n_chars", "doc_id", start, size).select("doc_id").collect()
                assert got == want, (query, term, start)
            n = docs.where(search.match(F.col("text"), query) & (F.col("lang") == term if term else F.lit(True))).count()
            assert search_index.total(spark, f"{tmp_path}/ix", query, term).first().total == n


def test_index_reads_the_buckets_of_the_query(spark, tmp_path):
    search_index.build(read_table(spark, SMALL, "documents"), f"{tmp_path}/ix", "text", "lang", "n_chars", "doc_id")
    plan = _plan(search_index.find(spark, f"{tmp_path}/ix", "license", "en"))
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("license")), F.lit(32))).first()[0]
    assert f"(bucket#" in plan and f"= {bucket})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "/ix/head" in plan and "EqualTo(token,license)" in plan.replace("In(token, [license])", "EqualTo(token,license)")


def test_pages_by_position(spark, tmp_path):
    rows = spark.createDataFrame([(None if i % 10 == 0 else i % 17, f"n{i % 5}") for i in range(300)], "a int, b string")
    ranged_table.write(rows, f"{tmp_path}/t", 6)
    assert ranged_table.total(spark, f"{tmp_path}/t") == 300
    everything = sales.detail_page(rows, 0, 1000).collect()
    for start, length in ((0, 10), (25, 10), (140, 60), (295, 10), (300, 10), (900, 5)):
        assert ranged_table.page_at(spark, f"{tmp_path}/t", rows.schema, start, length).collect() == everything[start:start + length]
    plan = _plan(ranged_table.page_at(spark, f"{tmp_path}/t", rows.schema, 150, 5))
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_keyset_pages_with_nulls(spark):
    rows = spark.createDataFrame([(None, None), (None, 1), (None, 1), (2, None), (2, 3), (5, 1)], "a int, b int")
    everything, seen, after = sales.detail_page(rows, 0, 100).collect(), [], None
    distinct = sorted(set(map(tuple, everything)), key=lambda r: tuple((x is not None, x or 0) for x in r))
    while page := sales.detail_page_after(rows.distinct(), after, 2).collect():
        seen += map(tuple, page)
        after = seen[-1]
    assert seen == distinct


def test_answer_scans_the_lines_once(spark):
    got = {r.section: r.body for r in sales_queries.q_sale_answer(spark, SMALL).collect()}
    assert got == {"total": '[{"value":0}]', "gender": "[]", "age": "[]", "detail": "[]"}  # no hits that day in the small table
    plan = _plan(sales_queries.q_sale_answer(spark, SMALL))
    assert "lineitem" not in plan  # computed once, into the scratch folder, which both passes read


def test_dau_incremental_leaves_the_store_where_it_is(spark):
    plan = dau_queries.q_dau_incremental(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert "Exchange" not in plan[plan.index("LeftAnti"):].split("Sort [_mid")[1]


@pytest.mark.parametrize("name", ["early", "late"])
def test_both_queries_judge_a_message_alike(spark, tmp_path, name):
    """Main and rejects queries whose batches run at different times lose and double nothing at either edge."""
    from tidemark.sources.streams import file_stream
    from tidemark.streaming import dau_stream

    at = 1_700_000_000_000
    edges = {"early": 86_400_000, "late": -40 * 86_400_000}[name]
    rows = [('{"ts":%d,"common":{"mid":"%d"},"page":{}}' % (at + edges + d, i), ) for i, d in enumerate((-2000, -1, 0, 1, 2000))]
    spark.createDataFrame(rows, "value string").withColumn("arrived", F.timestamp_millis(F.lit(at))).coalesce(1).write.parquet(f"{tmp_path}/src")
    stream = file_stream(spark, f"{tmp_path}/src", spark.read.parquet(f"{tmp_path}/src").schema)
    for start, path in ((dau_stream.start, "table"), (dau_stream.start_rejects, "rejects")):  # one after the other
        sinks.await_all([start(stream, f"{tmp_path}/{path}", f"{tmp_path}/ck_{path}", clock=F.col("arrived"), query_name=None)])
    stored = [r.mid for r in sinks.read_dau_table(spark, f"{tmp_path}/table").collect()]
    rejected = [r.mid for r in spark.read.parquet(f"{tmp_path}/rejects").collect()]
    assert sorted(stored + rejected) == ["0", "1", "2", "3", "4"]
    assert len(rejected) == 2
