"""Oracle SQL of the streaming twins: the batch oracle of the same result."""

from __future__ import annotations

from .cdc_oracle import SQL as CDC_SQL
from .dau_oracle import LOG
from .stream_queries import STATE_DELAY_DAYS

SQL = {
    "dau_stream_disorder": "WITH " + LOG + """
SELECT dt, mid, 'stored' AS outcome FROM dau
UNION ALL
SELECT strftime(make_timestamp(CAST('4' || CAST(ts AS VARCHAR) AS BIGINT) * 1000), '%Y-%m-%d'), mid, 'future'
FROM log WHERE event_id % 50 = 7""",
    "dau_late_merge": "WITH " + LOG + "\nSELECT dt, mid FROM dau",
    "dau_state_days": "WITH " + LOG + f"""
SELECT dt, count(*) AS devices FROM dau
WHERE CAST(dt AS DATE) > (SELECT max(CAST(dt AS DATE)) FROM dau) - {STATE_DELAY_DAYS} GROUP BY dt""",
    "sale_enriched_stream": CDC_SQL["sale_enriched"],
    "dau_hourly_stream": "WITH " + LOG + "\nSELECT dt, hr, count(*) AS cnt FROM dau GROUP BY dt, hr",
    "dau_stream": "WITH " + LOG + "\nSELECT dt, mid FROM dau",
    "cdc_stream": CDC_SQL["cdc_route_counts"],
    "dim_stream_latest": CDC_SQL["dim_latest_counts"],
}
