"""DuckDB oracle SQL for the search and nested-document queries."""

from __future__ import annotations

from .search_queries import ACTOR_NAME, CONV_QUERY, CONV_ROLE, DOC_LANG, DOC_QUERY, PAGE_SIZE


def _match(col: str, query: str) -> str:
    alts = "|".join(query.lower().split())
    return rf"regexp_matches({col}, '(^|[^\p{{L}}\p{{N}}])({alts})([^\p{{L}}\p{{N}}]|$)', 'i')"


def _highlight(col: str, query: str) -> str:
    toks = ", ".join(f"'{t}'" for t in query.lower().split())
    return (rf"array_to_string(list_transform(regexp_extract_all({col}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),"
            rf" lambda x: CASE WHEN lower(x) IN ({toks}) THEN '<em>' || x || '</em>' ELSE x END), '')")


HITS = (f"FROM documents WHERE {_match('text', DOC_QUERY)} AND lang = '{DOC_LANG}' "
        f"ORDER BY n_chars DESC, doc_id LIMIT {PAGE_SIZE}")

SQL = {
    "search_find": f"SELECT doc_id, lang, n_chars {HITS}",
    "search_indexed": f"SELECT doc_id, lang, n_chars {HITS}",
    "search_highlight": f"SELECT doc_id, {_highlight('text', DOC_QUERY)} AS highlight {HITS}",
    "search_grouped": f"""
WITH g AS (
  SELECT conv_id, arg_min(text, turn) AS name, bool_or(role = '{CONV_ROLE}') AS has, count(*) AS n_rows
  FROM conversations GROUP BY conv_id
)
SELECT conv_id, n_rows FROM g WHERE has AND {_match('name', CONV_QUERY)}
ORDER BY n_rows DESC, conv_id LIMIT {PAGE_SIZE}""",
    "nested_json_roundtrip": """
SELECT CAST(doc_id AS VARCHAR) AS id, lang || ':' || source AS name,
       CAST(n_chars AS DOUBLE) / 1000 AS "doubanScore", lang AS director_name,
       CAST(n_chars AS VARCHAR) AS second_actor, 2 AS n_actors
FROM documents""",
    "nested_search": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(n_chars AS DOUBLE) / 1000 AS "doubanScore"
FROM documents WHERE lang = '{ACTOR_NAME}' OR CAST(n_chars AS VARCHAR) = '{ACTOR_NAME}'
ORDER BY "doubanScore" DESC, id LIMIT {PAGE_SIZE}""",
}
