"""Time helpers (epoch millis, day and hour text, day arithmetic).

All are built-in column expressions, so they stay inside whole-stage
codegen.  Day and hour text follow the session time zone, which
``session.ensure_utc`` pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the day and hour text columns.
DATE_FMT = "yyyy-MM-dd"
HOUR_FMT = "HH"


def millis_to_ts(ms: Column) -> Column:
    """epoch millis -> timestamp."""
    return F.timestamp_millis(ms)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, DATE_FMT)


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, HOUR_FMT)


def day_hour_parts(ts: Column) -> Column:
    """``[day, hour]`` from one ``yyyy-MM-dd HH`` rendering split on the space."""
    return F.split(F.date_format(ts, f"{DATE_FMT} {HOUR_FMT}"), " ")


def parse_day(text: Column | str) -> Column:
    """Strict day parse: invalid text such as ``2020-13-01`` gives null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.try_to_date(col, DATE_FMT)


def previous_day(day: str) -> Column:
    """``yyyy-MM-dd`` text of the day before ``day``."""
    return F.date_format(F.date_sub(parse_day(F.lit(day)), 1), DATE_FMT)


def now_millis() -> Column:
    """Processing time in millis; constant within one query / micro-batch."""
    return F.unix_millis(F.current_timestamp())


def today_text() -> Column:
    return F.date_format(F.current_date(), DATE_FMT)


def to_long(text: Column) -> Column:
    """Text -> long, null when not a number.

    Integers parse directly; decimal or exponent text (``1704067432824.0``,
    ``1.7E12``) falls back to a decimal parse truncated to a long, as a
    lenient JSON getter would.  The fallback runs only for such text.
    """
    t = F.trim(text.cast("string"))
    return F.coalesce(t.try_cast("bigint"), t.try_cast("decimal(38,6)").try_cast("bigint"))
