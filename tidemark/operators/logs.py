"""Page-log parsing, day/hour derivation and the session-start filter.

All three are narrow, action-free ``DataFrame -> DataFrame`` transforms
that fuse into one codegen stage in batch and in a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonfn import corrupt_text, parse_once
from ..functions.schemas import CORRUPT, PAGE_LOG
from ..functions.timefn import day_text, hour_text, millis_to_ts, to_long


def parse(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> ``ts`` (long millis), ``common`` struct, ``page`` struct.

    Other input columns (e.g. ``event_id``, Kafka metadata) pass through.
    ``_corrupt_record`` holds the text of unparsable rows, and ``ts`` is
    null when missing or not a number; ``valid``/``quarantine`` split on that.
    """
    passthrough = [c for c in raw.columns if c != value_col]
    parsed = parse_once(raw, value_col, PAGE_LOG)
    return parsed.select(
        *passthrough,
        to_long(F.col("doc.ts")).alias("ts"),
        F.col("doc.common").alias("common"),
        F.col("doc.page").alias("page"),
        corrupt_text().alias(CORRUPT),
    )


def fault() -> F.Column:
    """Why a parsed row is kept aside: ``json``, ``ts``, ``common``; null for a good row."""
    return (F.when(F.col(CORRUPT).isNotNull(), "json").when(F.col("ts").isNull(), "ts")
            .when(F.col("common").isNull(), "common"))


def valid(parsed: DataFrame) -> DataFrame:
    """Rows that parsed and carry a numeric ``ts`` and a ``common`` part."""
    return parsed.where(fault().isNull()).drop(CORRUPT)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows kept aside instead of failing the batch, with their ``fault``."""
    return parsed.withColumn("fault", fault()).where(F.col("fault").isNotNull())


def with_dt_hr(df: DataFrame) -> DataFrame:
    """Add ``dt`` (yyyy-MM-dd) and ``hr`` (HH) from epoch-millis ``ts``."""
    ets = millis_to_ts(F.col("ts"))
    return df.withColumn("dt", day_text(ets)).withColumn("hr", hour_text(ets))


def session_starts(df: DataFrame) -> DataFrame:
    """First page of a session: ``page`` present, ``last_page_id`` null or empty."""
    last = F.col("page.last_page_id")
    return df.where(F.col("page").isNotNull() & (last.isNull() | (F.length(last) == 0)))


def prepared(raw: DataFrame) -> DataFrame:
    """parse -> valid -> dt/hr: the common head of every page-log job."""
    return with_dt_hr(valid(parse(raw)))
