"""DuckDB oracle SQL for the page-log and DAU queries.

Written independently of the Spark code, straight from the adapter table
in FIXTURES.md §2.1: the JSON round trip is skipped and the fields are
computed from ``events`` directly.
"""

from __future__ import annotations

from .dau_queries import ACTIVE_RANGES, CUT_NEW, CUT_STORED, REPORT_DAY

LOG = """
log AS (
  SELECT event_id,
         (epoch_us(ts) // 1000) AS ts,
         strftime(ts, '%Y-%m-%d') AS dt,
         strftime(ts, '%H') AS hr,
         CAST(user_id AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % 34 AS VARCHAR) AS ar,
         event_type AS ch,
         'v2.1.' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS vc,
         event_type <> 'error' AS has_page,
         CASE WHEN event_type = 'error' THEN NULL
              WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 10 < 3 THEN NULL
              WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 10 = 3 THEN ''
              ELSE 'page_' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) END
           AS last_page_id
  FROM events
),
starts AS (
  SELECT * FROM log WHERE has_page AND (last_page_id IS NULL OR length(last_page_id) = 0)
),
dau AS (
  SELECT mid, uid, ar, ch, vc, dt, hr, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn FROM starts
  ) WHERE rn = 1
)"""

YD = "2024-01-14"


def _with(body: str) -> str:
    return "WITH " + LOG + "\n" + body


def _hour_json(day: str) -> str:
    return (f"'{{' || coalesce(string_agg(CASE WHEN dt = '{day}' THEN '\"' || hr || '\":' || cnt END, ','"
            f" ORDER BY hr), '') || '}}'")


SQL = {
    "quarantine_log": """SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'json' WHEN event_id % 89 = 0 THEN 'common' ELSE 'ts' END AS fault
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0""",
    "dau_upsert": _with("SELECT dt, mid, min(ts) AS ts FROM starts GROUP BY dt, mid"),
    "log_parse_dt_hr": _with(
        "SELECT event_id, ts, dt, hr, mid, uid, ar, ch, vc, has_page, last_page_id FROM log"),
    "session_starts": _with("SELECT event_id, ts, dt, hr, mid FROM starts"),
    "dau_detail": _with("SELECT * FROM dau"),
    "dau_incremental": _with(f"""
, stored AS (
  SELECT dt, mid FROM starts WHERE ts < (epoch_us(TIMESTAMP '{CUT_STORED}') // 1000) GROUP BY dt, mid
), fresh AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn
    FROM starts WHERE ts >= (epoch_us(TIMESTAMP '{CUT_NEW}') // 1000)
  ) WHERE rn = 1
)
SELECT mid, uid, ar, ch, vc, dt, hr, ts FROM fresh f
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.dt = f.dt AND s.mid = f.mid)"""),
    "dau_first_seen": _with("SELECT mid, min(dt) AS first_dt FROM dau GROUP BY mid"),
    "active_over_days": _with(", seen AS (SELECT mid, min(dt) AS first_dt FROM dau GROUP BY mid)\n" + "\nUNION ALL\n".join(f"""
SELECT '{a}' AS first_day, '{b}' AS last_day, count(DISTINCT mid) AS active, count(DISTINCT mid) FILTER (WHERE first_dt < '{a}') AS returning,
       count(DISTINCT mid) FILTER (WHERE first_dt >= '{a}') AS new FROM dau JOIN seen USING (mid) WHERE dt BETWEEN '{a}' AND '{b}'"""
                                                            for a, b in ACTIVE_RANGES)),
    "dashboard_load": _with("SELECT 'dau' AS name, count(*) AS n FROM dau UNION ALL SELECT 'first_seen', count(DISTINCT mid) FROM dau"),
    "realtime_hour_response": _with(f"""
, per_hour AS (
  SELECT dt, hr, count(*) AS cnt FROM dau
  WHERE dt IN ('{REPORT_DAY}', '{YD}') AND hr IS NOT NULL GROUP BY dt, hr
)
SELECT '{{"today":' || {_hour_json(REPORT_DAY)} || ',"yesterday":' || {_hour_json(YD)} || '}}' AS body FROM per_hour"""),
    "dau_total": _with("SELECT dt, count(*) AS dau FROM dau GROUP BY dt"),
    "dau_hour_count": _with(f"""
SELECT hr, count(*) AS cnt FROM dau WHERE dt = '{REPORT_DAY}' AND hr IS NOT NULL
GROUP BY hr ORDER BY cnt DESC, hr LIMIT 24"""),
    "realtime_hour": _with(f"""
, per_hour AS (
  SELECT dt, hr, count(*) AS cnt FROM dau
  WHERE dt IN ('{REPORT_DAY}', '{YD}') AND hr IS NOT NULL GROUP BY dt, hr
)
SELECT {_hour_json(REPORT_DAY)} AS today, {_hour_json(YD)} AS yesterday FROM per_hour"""),
    "hourly_compare": _with(f"""
, spine AS (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hr FROM range(24)),
counts AS (
  SELECT hr, count(*) FILTER (WHERE dt = '{REPORT_DAY}') AS today,
             count(*) FILTER (WHERE dt = '{YD}') AS yesterday
  FROM dau WHERE dt IN ('{REPORT_DAY}', '{YD}') GROUP BY hr
)
SELECT s.hr, CAST(coalesce(c.today, 0) AS BIGINT) AS today,
       CAST(coalesce(c.yesterday, 0) AS BIGINT) AS yesterday
FROM spine s LEFT JOIN counts c ON s.hr = c.hr"""),
    "realtime_total": _with(f"""
SELECT 'dau' AS id, 'Daily active devices' AS name, count(*) AS value FROM dau WHERE dt = '{REPORT_DAY}'
UNION ALL
SELECT 'new_mid', 'New devices', count(*) FROM (
  SELECT mid FROM dau GROUP BY mid HAVING min(dt) = '{REPORT_DAY}')"""),
    "kpi_compare": _with(f"""
SELECT 'dau' AS id, 'Daily active devices' AS name,
       count(*) FILTER (WHERE dt = '{YD}') AS "yesData",
       count(*) FILTER (WHERE dt = '{REPORT_DAY}') AS "toData"
FROM dau WHERE dt IN ('{REPORT_DAY}', '{YD}')
UNION ALL
SELECT 'new_mid', 'New devices',
       count(*) FILTER (WHERE first_dt = '{YD}'),
       count(*) FILTER (WHERE first_dt = '{REPORT_DAY}')
FROM (SELECT mid, min(dt) AS first_dt FROM dau GROUP BY mid)
WHERE first_dt IN ('{REPORT_DAY}', '{YD}')"""),
}
