"""DuckDB oracle SQL for the sale queries (FIXTURES.md §2.3)."""

from __future__ import annotations

from .sales_queries import DEEP_PAGES, KEYWORD, PAGE_LENGTH, PAGE_START, SALE_DAY

WIDE = """
wide AS (
  SELECT o_orderkey AS order_id, l_linenumber AS line_no, c_custkey AS user_id, p_partkey AS sku_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender,
         CAST(15 + c_custkey % 30 AS INTEGER) AS user_age,
         CAST(1 + c_custkey % 10 AS INTEGER) AS user_level,
         l_extendedprice AS sku_price, p_name AS sku_name, p_brand AS sku_tm_id, n_name AS province,
         strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

ALL_COLS = ("order_id, line_no, user_id, sku_id, user_gender, user_age, user_level, sku_price, "
            "sku_name, sku_tm_id, province, dt")
ORDER = ", ".join(f"{c.strip()} NULLS FIRST" for c in ALL_COLS.split(","))
KW = f"list_has_any(string_split_regex(lower(trim(sku_name)), '\\s+'), ['{KEYWORD}'])"
DAY = f"dt = '{SALE_DAY}'"


def _w(body: str) -> str:
    return "WITH " + WIDE + "\n" + body


def _share(expr: str) -> str:
    return _w(f"""
, c AS (SELECT {expr} AS name, count(*) AS value FROM wide WHERE {DAY} GROUP BY 1)
SELECT name, value, CAST(value * 100 AS DOUBLE) / sum(value) OVER () AS share_pct FROM c""")


SQL = {
    "sale_wide": _w(f"SELECT {ALL_COLS} FROM wide"),
    "sale_detail_page": _w(f"SELECT {ALL_COLS} FROM wide WHERE {DAY} ORDER BY {ORDER} "
                           f"LIMIT {PAGE_LENGTH} OFFSET {PAGE_START}"),
    "sale_keyword_page": _w(f"SELECT {ALL_COLS} FROM wide WHERE {DAY} AND {KW} ORDER BY {ORDER} "
                            f"LIMIT {PAGE_LENGTH}"),
    "sale_page_after": _w(f"SELECT {ALL_COLS} FROM wide WHERE {DAY} ORDER BY {ORDER} "
                          f"LIMIT {PAGE_LENGTH} OFFSET {PAGE_START + PAGE_LENGTH}"),
    "sale_page_at": _w(f""", w AS (SELECT * REPLACE (CASE WHEN order_id % 50 <> 0 THEN order_id END AS order_id) FROM wide),
placed AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) - 1 AS nth, count(*) OVER () AS total FROM w),
pages AS (SELECT page, least(CAST(floor(share * (SELECT max(total) FROM placed)) AS BIGINT),
                             (SELECT max(total) FROM placed) - {PAGE_LENGTH // 2}) AS start
          FROM (VALUES {', '.join(f'({i}, CAST({s} AS DOUBLE))' for i, s in enumerate(DEEP_PAGES))}) AS p(page, share))
SELECT {ALL_COLS}, page FROM placed JOIN pages ON nth >= start AND nth < start + {PAGE_LENGTH}"""),
    "sale_answer": _w(f""", d AS (SELECT *, CASE WHEN user_age < 20 THEN 'under 20' WHEN user_age < 30 THEN '20 to 30' ELSE '30 and over' END AS band
  FROM wide WHERE {DAY}),
t AS (SELECT count(*) AS total FROM d),
f AS (SELECT 'gender' AS section, user_gender AS name, count(*) AS value FROM d GROUP BY user_gender
      UNION ALL SELECT 'age', band, count(*) FROM d GROUP BY band),
page AS (SELECT * FROM d ORDER BY {ORDER} LIMIT {PAGE_LENGTH} OFFSET {PAGE_START})
SELECT 'total' AS section, '[{{"value":' || total || '}}]' AS body FROM t
UNION ALL
SELECT s.section, '[' || coalesce(string_agg('{{"name":"' || name || '","value":' || value || ',"share":"' || printf('%.2f', value * 100 / total) || '%"}}',
                                  ',' ORDER BY name), '') || ']'
FROM (VALUES ('gender'), ('age')) AS s(section) LEFT JOIN f ON f.section = s.section CROSS JOIN t GROUP BY s.section
UNION ALL
SELECT 'detail', '[' || coalesce(string_agg('{{"order_id":' || order_id || ',"line_no":' || line_no || ',"user_id":' || user_id || ',"sku_id":' || sku_id
  || ',"user_gender":"' || user_gender || '","user_age":' || user_age || ',"user_level":' || user_level || ',"sku_price":' || sku_price
  || ',"sku_name":"' || sku_name || '","sku_tm_id":"' || sku_tm_id || '","province":"' || province || '","dt":"' || dt || '"}}', ',' ORDER BY {ORDER}), '') || ']'
FROM page"""),
    "sale_rollup": """
WITH l AS (SELECT CASE WHEN l_orderkey % 5 = 0 AND l_partkey > 1 THEN l_partkey - 1 ELSE l_partkey END AS sku, l_orderkey,
  CAST(l_extendedprice AS DECIMAL(18,2)) + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS amount
  FROM lineitem WHERE l_orderkey % 7 <> 0),
j AS (SELECT n_name AS province, p_name AS name, amount FROM l JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON sku = p_partkey)
SELECT 'province' AS grouping, province AS value, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM j GROUP BY province
UNION ALL
SELECT 'name', name, count(*), CAST(sum(amount) AS DOUBLE) FROM j GROUP BY name""",
    "sale_detail_total": _w(f"SELECT count(*) AS total FROM wide WHERE {DAY} AND {KW}"),
    "sale_facet_gender": _share("user_gender"),
    "sale_facet_age": _share("CASE WHEN user_age < 20 THEN 'under 20' WHEN user_age < 30 THEN '20 to 30' "
                             "ELSE '30 and over' END"),
    "sale_by_province": """
SELECT n_name AS province, count(*) AS value, round(sum(l_extendedprice), 2) AS amount,
       CAST(least(floor(count(*) / 100) * 100, 500) AS BIGINT) AS band
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""",
    "sale_by_name": """
SELECT p_name AS name, count(*) AS num, round(sum(l_extendedprice), 2) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""",
}
