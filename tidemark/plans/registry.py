"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from . import (cdc_oracle, cdc_queries, dau_oracle, dau_queries, sales_oracle, sales_queries,
               search_oracle, search_queries, stream_oracle, stream_queries)

# (queries, oracle) module pairs, one per query family.
FAMILIES = (
    (dau_queries, dau_oracle),
    (cdc_queries, cdc_oracle),
    (sales_queries, sales_oracle),
    (search_queries, search_oracle),
    (stream_queries, stream_oracle),
)


def all_queries() -> dict:
    out = {}
    for queries, _ in FAMILIES:
        out.update(queries.QUERIES)
    return out


def all_oracle_sql() -> dict:
    out = {}
    for _, oracle in FAMILIES:
        out.update(oracle.SQL)
    return out
