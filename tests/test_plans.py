"""Physical-plan properties the design relies on (checked with explain)."""

import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E
from helpers import SMALL
from tidemark.plans import dau_queries, sales_queries, stream_queries

BATCH = sorted(k for k in E.queries() if k not in stream_queries.QUERIES)


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_dedup_is_partial_before_shuffle(spark):
    plan = _plan(dau_queries.dau_table(spark, SMALL))
    blocks = [b.strip() for b in plan.split("\n\n") if b.strip().startswith("(")]

    def node_id(block):
        return int(block[1:block.index(")")])

    partial = [node_id(b) for b in blocks if "Aggregate" in b.split("\n")[0] and "partial_min(" in b]
    final = [node_id(b) for b in blocks if "Aggregate" in b.split("\n")[0] and " min(struct" in b]
    shuffle = [node_id(b) for b in blocks if b.split("\n")[0].endswith("Exchange")
               and re.search(r"hashpartitioning\(dt#\d+, mid#\d+", b)]
    # Nodes are numbered bottom-up: map-side partial, then the (dt, mid) shuffle, then the final merge.
    assert len(partial) == len(shuffle) == len(final) == 1
    assert partial[0] < shuffle[0] < final[0]


def test_json_parsed_once_per_row(spark):
    plan = _plan(dau_queries.q_session_starts(spark, SMALL), "extended")
    optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("from_json(") == 1


def test_day_filter_reaches_parquet(spark):
    plan = _plan(sales_queries.q_sale_detail_page(spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)


@pytest.mark.parametrize("name, scans", [("dau_hour_count", 1), ("realtime_hour", 1), ("hourly_compare", 1),
                                         ("realtime_total", 2), ("kpi_compare", 2)])
def test_dashboard_reads_only_the_days_of_the_stored_tables(spark, name, scans):
    plan = _plan(E.queries()[name](spark, SMALL))
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", plan)
    assert len(filters) == scans and all("2024-01-15" in f for f in filters)
    assert "from_json" not in plan and "events.parquet" not in plan


def test_incremental_reads_its_batch_once(spark):
    plan = _plan(dau_queries.q_dau_incremental(spark, SMALL))
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", plan)
    assert any("2024-01-15" in f for f in filters), plan
    assert "events.parquet" not in plan  # parsed once, when the batch was written


def test_column_pruning_on_lineitem(spark):
    plan = _plan(sales_queries.q_sale_by_name(spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    li = [s for s in schemas if "l_partkey" in s]
    assert li and all(set(f.split(":")[0] for f in s.split(",")) == {"l_partkey", "l_extendedprice"}
                      for s in li)


def test_by_province_aggregates_before_joins(spark):
    plan = _plan(sales_queries.q_sale_by_province(spark, SMALL))
    blocks = [b.strip() for b in plan.split("\n\n")]
    partial = [b for b in blocks if b.startswith("(") and "Aggregate" in b.split("\n")[0]
               and "partial_" in b]
    # Lines are summed per order, then per customer, then per nation, each before its join.
    assert any("Keys [1]: [l_orderkey" in b for b in partial)
    assert any("Keys [1]: [o_custkey" in b for b in partial)
    assert any("Keys [1]: [c_nationkey" in b for b in partial)
    # No join sees line-level rows: the only join inputs carrying a line column are aggregates.
    joins = [b for b in blocks if b.startswith("(") and "Join" in b.split("\n")[0]]
    assert len(joins) == 3
    assert not any("l_extendedprice" in b for b in joins)
