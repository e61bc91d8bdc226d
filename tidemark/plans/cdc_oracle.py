"""DuckDB oracle SQL for the change-record queries (from FIXTURES.md §2.2)."""

from __future__ import annotations

FACTS = """
facts AS (
  SELECT 'DWD_ORDER_INFO_' || CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' WHEN 'P' THEN 'D' END
           AS topic,
         pos, CAST(NULL AS BIGINT) AS line_no, o_orderkey AS record_id, o_totalprice + pos AS amount
  FROM orders, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) AS p(pos)
  WHERE o_orderkey % 97 <> 0 AND o_orderstatus IN ('F', 'O', 'P') AND (pos = 0 OR o_orderstatus = 'O')
  UNION ALL
  SELECT 'DWD_ORDER_DETAIL_I', 0, l_linenumber, l_orderkey, l_extendedprice
  FROM lineitem
)"""

# Dimension changelog: (dim_table, pk, seq, type, name, balance), keyable rows only.
DIMS = """
dims AS (
  SELECT 'user_info' AS dim_table, CAST(c_custkey AS VARCHAR) AS pk, c_custkey * 10 + 2 AS seq,
         'INSERT' AS type, c_name AS name, c_acctbal AS balance
  FROM customer WHERE c_custkey % 100 <> 0
  UNION ALL
  SELECT 'user_info', CAST(c_custkey AS VARCHAR), c_custkey * 10 + 3, 'UPDATE', c_name, c_acctbal + 1
  FROM customer WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT 'user_info', CAST(c_custkey AS VARCHAR), c_custkey * 10 + 4, 'DELETE', c_name, c_acctbal
  FROM customer WHERE c_custkey % 50 = 1
  UNION ALL
  SELECT 'sku_info', CAST(p_partkey AS VARCHAR), p_partkey * 10 + 5, 'INSERT', p_name, NULL FROM part
  UNION ALL
  SELECT 'base_province', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS BIGINT) * 10 + 6, 'INSERT',
         n_name, NULL FROM nation
),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dim_table, pk ORDER BY seq DESC) AS rn FROM dims
  ) WHERE rn = 1
)"""

LATEST_ROWS = "WITH " + DIMS + """
SELECT 'DIM:' || upper(dim_table) || ':' || pk AS dim_key, dim_table, pk, type AS latest_type, seq,
       name, balance
FROM latest"""

SQL = {
    "quarantine_cdc": """
SELECT 'order_info' AS "table", 'type' AS fault, count(*) AS n FROM orders
WHERE o_orderkey % 97 = 0 OR o_orderstatus NOT IN ('F', 'O', 'P') HAVING count(*) > 0
UNION ALL
SELECT 'user_info', 'pk_names', count(*) FROM customer WHERE c_custkey % 100 = 0 HAVING count(*) > 0""",
    "cdc_route_facts": "WITH " + FACTS + "\nSELECT topic, pos, line_no, record_id, amount FROM facts",
    "cdc_route_counts": "WITH " + FACTS + "\nSELECT topic, count(*) AS n FROM facts GROUP BY topic",
    "dim_latest_counts": "WITH " + DIMS + """
SELECT dim_table, count(*) AS n_keys,
       count(*) FILTER (WHERE type = 'UPDATE') AS n_updated,
       count(*) FILTER (WHERE type = 'DELETE') AS n_deleted
FROM latest GROUP BY dim_table""",
    "dim_latest_rows": LATEST_ROWS,
    "dim_compact": LATEST_ROWS,
    "dim_live_keys": "WITH " + DIMS + """
SELECT dim_table, count(*) AS n_live FROM latest WHERE type <> 'DELETE' GROUP BY dim_table""",
    "cdc_routes": "WITH " + FACTS + "," + DIMS + """
SELECT topic AS route, count(*) AS n FROM facts GROUP BY topic
UNION ALL
SELECT 'DIM_' || upper(dim_table), count(*) FROM dims GROUP BY dim_table""",
    "cdc_message_keys": "WITH " + FACTS + "," + DIMS + """
SELECT topic AS route, count(*) AS n,
       CASE WHEN topic LIKE 'DWD_ORDER_INFO_%' THEN count(*) ELSE 0 END AS keyed
FROM facts GROUP BY topic
UNION ALL
SELECT 'DIM_' || upper(dim_table), count(*), count(*) FROM dims GROUP BY dim_table""",
    "snapshot_envelopes": """
SELECT 'user_info' AS dim_table, 'INSERT' AS type, 'DIM:USER_INFO:' || c_custkey AS dim_key, c_name AS name
FROM customer
UNION ALL
SELECT 'sku_info', 'INSERT', 'DIM:SKU_INFO:' || p_partkey, p_name FROM part
UNION ALL
SELECT 'base_province', 'INSERT', 'DIM:BASE_PROVINCE:' || n_nationkey, n_name FROM nation""",
    "sale_enriched": "WITH " + DIMS + """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_extendedprice AS price, o_custkey AS user_id,
       strftime(o_orderdate, '%Y-%m-%d') AS dt, u.name AS user_name, l_partkey AS sku_id, p_name AS sku_name,
       p_brand AS sku_brand
FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 97 <> 0 AND o_orderstatus IN ('F', 'O', 'P')
LEFT JOIN latest u ON u.dim_table = 'user_info' AND u.pk = CAST(o_custkey AS VARCHAR)
LEFT JOIN part ON p_partkey = l_partkey""",
    "cdc_payload_exact": """
SELECT o_orderkey AS record_id, '9' || lpad(CAST(o_orderkey AS VARCHAR), 17, '0') || '.89' AS total FROM orders""",
    "dim_full_key": r"""
SELECT 'DIM:SKU_INFO:' || p_brand || ':' || split_part(p_name, ' ', 1) || '\:\\' || p_partkey % 7 AS dim_key,
       count(*) AS n
FROM part WHERE p_partkey % 10 <> 0 AND p_brand IS NOT NULL AND p_name IS NOT NULL GROUP BY ALL""",
}
