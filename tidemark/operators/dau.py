"""Daily active devices: flatten to facts, keep one row per (dt, mid).

Batch dedup is an aggregate, not a window: ``min(struct(ts, event_id,
...))`` per ``(dt, mid)``.  The aggregate runs partial-then-final, so each
map task ships at most one row per device-day; a device that holds a
third of all rows is collapsed before the shuffle instead of landing, in
full, in one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.timefn import now_millis

KEYS = ("dt", "mid")
FACT_COLUMNS = ("mid", "uid", "ar", "ch", "vc", "dt", "hr", "ts")


def to_fact(df: DataFrame, stamp: str = "event", keep: Sequence[str] = ("event_id",)) -> DataFrame:
    """Flatten a parsed session start to the DAU detail row.

    ``stamp="event"`` keeps the event time in ``ts`` (deterministic);
    ``stamp="processing"`` stamps the processing time as the source system
    did.  Columns in ``keep`` that exist (the dedup tie-break) pass through.
    """
    ts: Column = F.col("ts") if stamp == "event" else now_millis()
    extra = [c for c in keep if c in df.columns]
    return df.select(
        F.col("common.mid").alias("mid"),
        F.col("common.uid").alias("uid"),
        F.col("common.ar").alias("ar"),
        F.col("common.ch").alias("ch"),
        F.col("common.vc").alias("vc"),
        "dt", "hr", ts.alias("ts"), *extra,
    )


def dedup(facts: DataFrame, keys: Sequence[str] = KEYS,
          order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """First row per key by ``order`` (event time, then event id).

    Rows without a device id cannot be keyed and are left out.
    """
    order = [c for c in order if c in facts.columns]
    rest = [c for c in facts.columns if c not in keys and c not in order]
    keyed = facts.where(F.col(keys[-1]).isNotNull() & F.col(keys[0]).isNotNull())
    first = F.min(F.struct(*order, *rest)).alias("_first")
    out = keyed.groupBy(*keys).agg(first).select(*keys, "_first.*")
    return out.select(*facts.columns)


def incremental(batch_facts: DataFrame, existing: DataFrame,
                keys: Sequence[str] = KEYS, days: Sequence[str] | None = None) -> DataFrame:
    """Add-if-absent: rows of a new batch whose ``(dt, mid)`` is not stored yet.

    ``existing`` is the stored DAU table; only its key columns are read.
    With ``days``, the batch's days, it is cut to them by literals, which
    prunes a partitioned table, and the batch is read once (see
    ``sinks.add_absent``).  Without, it is cut, map side, by a semi join
    against the batch's distinct ``dt`` values, broadcast because a
    day set has at most one row per calendar day (36,525 rows per
    century).  A shuffle join on ``dt`` alone would send each stored day
    to one task.  The anti join then shuffles the batch's days only.
    """
    fresh = dedup(batch_facts, keys)
    stored = existing.select(*keys)
    if days is not None:
        stored = stored.where(F.col(keys[0]).isin(list(days)))
    else:
        stored = stored.join(F.broadcast(fresh.select(keys[0]).distinct()), keys[0], "left_semi")
    return fresh.join(stored, list(keys), "left_anti")


def first_seen(dau: DataFrame) -> DataFrame:
    """First day each device was seen, ``(mid, first_dt)`` (partial + final min per ``mid``).

    The min runs over the date value (fixed width, hash aggregate) rather
    than the text (sort aggregate), and is rendered back to text once.
    """
    first = F.min(F.try_to_date(F.col("dt"), "yyyy-MM-dd"))
    return dau.groupBy("mid").agg(F.date_format(first, "yyyy-MM-dd").alias("first_dt"))


def detail(facts: DataFrame) -> DataFrame:
    """DAU detail rows in the fixed column order, tie-break columns dropped."""
    return facts.select(*FACT_COLUMNS)


def observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count metric gathered during the next action (diagnostic)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
