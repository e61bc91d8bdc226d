"""Dashboard queries over the DAU table (one row per ``(dt, mid)``).

The DAU table is ``dt``-partitioned when stored (``sinks.dau_table``), so
every day filter below is a literal on ``dt`` and prunes partitions.  All
aggregates run partial + final; the only single-task steps run on
outputs bounded by construction (24 hours, 2 days, 2 KPI rows).
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dau as dau_ops

HOURS = 24

# Fixed KPI ids and display names of the dashboard's tab list.
KPI_DAU = ("dau", "Daily active devices")
KPI_NEW_MID = ("new_mid", "New devices")


def resolve_day(day: str | None) -> str:
    """The requested day, or today (UTC) when none is given; invalid dates are rejected.

    Resolved on the driver to a literal, so the ``dt`` filter still prunes
    partitions (``current_date()`` would too, but this keeps one clock per
    request across the several scans of one answer).
    """
    if day is None:
        return datetime.now(timezone.utc).date().isoformat()
    return date.fromisoformat(day).isoformat()


def day_before(day: str) -> str:
    """``yyyy-MM-dd`` of the previous day; invalid dates are rejected."""
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Device count per day; for one ``day``, exactly one row (0 when it has no devices)."""
    if day is None:
        return dau.groupBy("dt").agg(F.count(F.lit(1)).alias("dau"))
    day = resolve_day(day)
    return (dau.where(F.col("dt") == F.lit(day))
               .agg(F.count(F.lit(1)).alias("dau"))
               .select(F.lit(day).alias("dt"), "dau"))


def dau_hour_count(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Devices per hour of one day, at most 24 buckets, largest first."""
    day = resolve_day(day)
    return (dau.where(F.col("dt") == F.lit(day))
               .where(F.col("hr").isNotNull())
               .groupBy("hr").agg(F.count(F.lit(1)).alias("cnt"))
               .orderBy(F.desc("cnt"), F.asc("hr"))
               .limit(HOURS))


def _hour_map(day_col: str, day: str) -> F.Column:
    entry = F.when(F.col(day_col) == F.lit(day), F.struct("hr", "cnt"))
    return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))


def realtime_hour(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``{today: {hr: n}, yesterday: {hr: n}}`` as two JSON-text columns, one row.

    The two days are read in one scan; the hour maps hold at most 24 keys.
    """
    day = resolve_day(day)
    yd = day_before(day)
    per_hour = (dau.where(F.col("dt").isin(day, yd) & F.col("hr").isNotNull())
                   .groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("cnt")))
    return per_hour.agg(_hour_map("dt", day).alias("today"),
                        _hour_map("dt", yd).alias("yesterday"))


def realtime_hour_response(dau: DataFrame, day: str | None = None) -> DataFrame:
    """The endpoint's whole answer as one JSON document: ``{"today": {...}, "yesterday": {...}}``."""
    maps = realtime_hour(dau, day)
    body = F.concat(F.lit('{"today":'), F.col("today"), F.lit(',"yesterday":'), F.col("yesterday"), F.lit("}"))
    return maps.select(body.alias("body"))


def json_list(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """A small answer (KPI list, facets, one page) as one JSON array document ``body``.

    Only for results bounded by construction (a few rows): the rows are
    gathered into one array in one task.  Sorted by ``order`` so the
    document is deterministic.
    """
    cols = list(order) + [c for c in rows.columns if c not in order]
    items = F.array_sort(F.collect_list(F.struct(*cols)))
    return rows.agg(F.to_json(items).alias("body"))


def hourly_compare(dau: DataFrame, day: str | None = None) -> DataFrame:
    """24 rows ``(hr, today, yesterday)``; hours without devices give 0."""
    day = resolve_day(day)
    yd = day_before(day)
    spark = dau.sparkSession
    hours = [f"{h:02d}" for h in range(HOURS)]
    # Only the 24 spine hours can match, so keep only them: the aggregate is then
    # at most 24 rows whatever the input holds, which bounds the broadcast below.
    counts = (dau.where(F.col("dt").isin(day, yd) & F.col("hr").isin(hours))
                 .groupBy("hr")
                 .agg(F.count(F.when(F.col("dt") == day, 1)).alias("today"),
                      F.count(F.when(F.col("dt") == yd, 1)).alias("yesterday")))
    spine = spark.range(HOURS).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    # Both sides hold at most 24 rows (filtered above), so the broadcast is bounded.
    joined = spine.join(F.broadcast(counts), "hr", "left")
    return joined.select("hr",
                         F.coalesce("today", F.lit(0)).cast("bigint").alias("today"),
                         F.coalesce("yesterday", F.lit(0)).cast("bigint").alias("yesterday"))


def realtime_total(dau: DataFrame, day: str | None = None, first_seen: DataFrame | None = None) -> DataFrame:
    """KPI list ``(id, name, value)`` for one day.

    ``first_seen`` is the maintained ``(mid, first_dt)`` table; without it
    new devices are found by grouping the whole history.
    """
    day = resolve_day(day)
    first_seen = dau_ops.first_seen(dau) if first_seen is None else first_seen
    active = (dau.where(F.col("dt") == F.lit(day))
                 .agg(F.count(F.lit(1)).alias("value"))
                 .select(F.lit(KPI_DAU[0]).alias("id"), F.lit(KPI_DAU[1]).alias("name"), "value"))
    new = (first_seen.where(F.col("first_dt") == F.lit(day))
              .agg(F.count(F.lit(1)).alias("value"))
              .select(F.lit(KPI_NEW_MID[0]).alias("id"), F.lit(KPI_NEW_MID[1]).alias("name"), "value"))
    return active.unionByName(new)


def kpi_compare(dau: DataFrame, day: str | None = None, first_seen: DataFrame | None = None) -> DataFrame:
    """KPI list ``(id, name, yesData, toData)``: yesterday beside today (``first_seen`` as above)."""
    day = resolve_day(day)
    yd = day_before(day)
    first_seen = dau_ops.first_seen(dau) if first_seen is None else first_seen
    active = (dau.where(F.col("dt").isin(day, yd))
                 .agg(F.count(F.when(F.col("dt") == yd, 1)).alias("yesData"),
                      F.count(F.when(F.col("dt") == day, 1)).alias("toData"))
                 .select(F.lit(KPI_DAU[0]).alias("id"), F.lit(KPI_DAU[1]).alias("name"),
                         "yesData", "toData"))
    new = (first_seen.where(F.col("first_dt").isin(day, yd))
              .agg(F.count(F.when(F.col("first_dt") == yd, 1)).alias("yesData"),
                   F.count(F.when(F.col("first_dt") == day, 1)).alias("toData"))
              .select(F.lit(KPI_NEW_MID[0]).alias("id"), F.lit(KPI_NEW_MID[1]).alias("name"),
                      "yesData", "toData"))
    return active.unionByName(new)


def dau_scan(spark, path: str, day: str | None = None) -> DataFrame:
    """Read a stored, ``dt``-partitioned DAU table; a day selects one partition.

    Read with the declared schema, so ``dt`` stays text whatever the
    session's partition type inference says.
    """
    from ..functions.schemas import DAU_INFO

    df = spark.read.schema(DAU_INFO).option("basePath", path).parquet(path)
    return df if day is None else df.where(F.col("dt") == F.lit(day))
