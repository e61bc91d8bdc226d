"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from helpers import SMALL, digest, rows_of
from tidemark.plans import registry

QUERIES = registry.all_queries()
ORACLE = registry.all_oracle_sql()


PLANNED = {
    "log_parse_dt_hr", "session_starts", "dau_detail", "dau_incremental", "dau_total", "dau_hour_count",
    "realtime_hour", "hourly_compare", "realtime_total", "kpi_compare", "cdc_route_facts", "cdc_route_counts",
    "dim_latest_counts", "dim_latest_rows", "snapshot_envelopes", "sale_wide", "sale_detail_page",
    "sale_facet_gender", "sale_facet_age", "sale_by_province", "sale_by_name", "search_find",
    "nested_json_roundtrip", "dau_stream", "cdc_stream",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_all_of_them():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


def test_every_planned_query_is_registered():
    assert PLANNED <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols, rows = df.columns, rows_of(df)
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hr", "cnt"]
    rows = df.collect()
    assert len(rows) == 7
    assert sum(r.cnt for r in rows) == 8


def test_fixture_counts(spark):
    from tidemark.plans import dau_queries as D
    from tidemark.operators import logs

    starts = logs.session_starts(D.parsed_log(spark, SMALL))
    assert starts.count() == 346
    assert D.dau_table(spark, SMALL).count() == 234
