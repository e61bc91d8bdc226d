"""Registered page-log and DAU queries over the warehouse tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the whole
``events`` table through the page-log adapter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import dau as dau_ops
from ..operators import logs, serving
from ..session import scratch_path
from ..sinks import device_bitmaps
from ..sources.adapters import raw_log
from ..sources.tables import table_path

# Fixed query parameters of the test fixtures.
REPORT_DAY = "2024-01-15"
# Two overlapping loads for the add-if-absent check: the stored table holds
# everything before CUT_STORED, the new load everything from CUT_NEW on.
CUT_STORED = "2024-01-15 12:00:00"
CUT_NEW = "2024-01-15 00:00:00"


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.prepared(raw_log(spark, sf_dir))


def dau_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session starts flattened to facts, tie-break ``event_id`` kept."""
    return dau_ops.to_fact(logs.session_starts(parsed_log(spark, sf_dir)))


def dau_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DAU table: first session start per (dt, mid)."""
    return dau_ops.detail(dau_ops.dedup(dau_facts(spark, sf_dir)))


def dau_view(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """The DAU table narrowed to ``columns`` (always with ``dt`` and ``mid``).

    Only the named columns ride in the dedup's first-row struct, so the
    dedup shuffle carries nothing a query does not read; with no extra
    column Catalyst drops the struct aggregate and keeps a distinct.
    """
    extra = [c for c in columns if c not in ("dt", "mid")]
    facts = dau_facts(spark, sf_dir).select("dt", "mid", "ts", "event_id", *extra)
    return dau_ops.dedup(facts).select("dt", "mid", *extra)


# Stored tables of this process, by session, input folder and state of the ``events`` files.
_STORED: dict[tuple, str] = {}


def stored_tables(spark: SparkSession, sf_dir: str) -> str:
    """Folder holding the dashboard's stored tables, loaded from the whole log when first asked for.

    ``dau`` is the ``dt``-partitioned DAU table, ``first_seen`` the first day of each device.  As in
    production, the load is a job of its own and the dashboard queries read what it stored.
    """
    files = spark.read.format("binaryFile").load(table_path(sf_dir, "events")) \
                 .select("path", "modificationTime", "length").collect()
    state = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(tuple(f) for f in files)))
    if state not in _STORED:
        _STORED[state] = load_dashboard(spark, sf_dir)
    return _STORED[state]


def load_dashboard(spark: SparkSession, sf_dir: str) -> str:
    """Load the dashboard's tables from the whole log into a new folder."""
    base = scratch_path(spark, "dashboard")
    sinks.dau_table(dau_table(spark, sf_dir), f"{base}/dau")
    sinks.first_seen_table(sinks.read_dau_table(spark, f"{base}/dau"), f"{base}/first_seen")
    return base


def stored_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.dau_scan(spark, f"{stored_tables(spark, sf_dir)}/dau")


def stored_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.read_first_seen(spark, f"{stored_tables(spark, sf_dir)}/first_seen")


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page log with some messages cut short, some without ``common`` and some without ``ts``."""
    raw = raw_log(spark, sf_dir)
    by = F.col("event_id")
    value = (F.when(by % 97 == 0, F.expr("left(value, length(value) - 3)"))
             .when(by % 89 == 0, F.regexp_replace("value", '"common":', '"other":'))
             .when(by % 83 == 0, F.regexp_replace("value", '"ts":', '"tz":')).otherwise(F.col("value")))
    return raw.withColumn("value", value)


def q_quarantine_log(spark, sf_dir):
    """Messages kept aside, with the reason."""
    return logs.quarantine(logs.parse(damaged_log(spark, sf_dir))).select("event_id", "fault")


def q_dau_upsert(spark, sf_dir):
    """A table loaded in two overlapping parts, the second of them twice."""
    path = scratch_path(spark, "dau_upsert")
    facts = dau_facts(spark, sf_dir)
    first = dau_ops.detail(dau_ops.dedup(facts.where(F.col("hr") >= "10")))
    second = dau_ops.detail(dau_ops.dedup(facts.where(F.col("hr") < "14")))
    for part in (first, second, second):
        sinks.dau_table(part, f"{path}/table", mode="upsert")
    return sinks.read_dau_table(spark, f"{path}/table").select("dt", "mid", "ts")


def q_log_parse_dt_hr(spark, sf_dir):
    df = parsed_log(spark, sf_dir)
    return df.select(
        "event_id", "ts", "dt", "hr",
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
        F.col("common.ar").alias("ar"), F.col("common.ch").alias("ch"),
        F.col("common.vc").alias("vc"),
        F.col("page").isNotNull().alias("has_page"),
        F.col("page.last_page_id").alias("last_page_id"),
    )


def q_session_starts(spark, sf_dir):
    return (logs.session_starts(parsed_log(spark, sf_dir))
            .select("event_id", "ts", "dt", "hr", F.col("common.mid").alias("mid")))


def q_dau_detail(spark, sf_dir):
    return dau_table(spark, sf_dir)


def q_dau_incremental(spark, sf_dir):
    """A stored table, and a later load that overlaps it: the device-days the table lacks."""
    path = scratch_path(spark, "dau_incremental")
    facts = dau_facts(spark, sf_dir)
    ets = F.timestamp_millis("ts")
    before = dau_ops.dedup(facts.where(ets < F.to_timestamp(F.lit(CUT_STORED))))
    sinks.append_bucketed(dau_ops.detail(before), f"{path}/dau")
    new_load = facts.where(ets >= F.to_timestamp(F.lit(CUT_NEW)))
    return dau_ops.detail(sinks.add_absent_bucketed(new_load, f"{path}/dau"))


def q_dau_first_seen(spark, sf_dir):
    """The first-seen table after two loads, the later days first."""
    path = scratch_path(spark, "first_seen")
    dau = dau_view(spark, sf_dir, ())
    for part in (dau.where(F.col("dt") >= REPORT_DAY), dau.where(F.col("dt") < REPORT_DAY)):
        sinks.first_seen_table(part, path)
    return sinks.read_first_seen(spark, path)


def q_dau_total(spark, sf_dir):
    return serving.dau_total(stored_dau(spark, sf_dir))


def q_dau_hour_count(spark, sf_dir):
    return serving.dau_hour_count(stored_dau(spark, sf_dir), REPORT_DAY)


def q_realtime_hour(spark, sf_dir):
    return serving.realtime_hour(stored_dau(spark, sf_dir), REPORT_DAY)


def q_hourly_compare(spark, sf_dir):
    return serving.hourly_compare(stored_dau(spark, sf_dir), REPORT_DAY)


def q_realtime_total(spark, sf_dir):
    return serving.realtime_total(stored_dau(spark, sf_dir), REPORT_DAY, stored_first_seen(spark, sf_dir))


def q_kpi_compare(spark, sf_dir):
    return serving.kpi_compare(stored_dau(spark, sf_dir), REPORT_DAY, stored_first_seen(spark, sf_dir))


# Ranges of days asked of the device bitmaps.
ACTIVE_RANGES = (("2024-01-01", "2024-01-07"), ("2024-01-10", "2024-01-16"), ("2024-01-15", "2024-01-15"))


def q_active_over_days(spark, sf_dir):
    """Active, returning and new devices of ranges of days, from bitmaps merged in two loads, one of them twice."""
    path = scratch_path(spark, "device_bitmaps")
    dau = dau_view(spark, sf_dir, ())
    later, earlier = dau.where(F.col("dt") >= "2024-01-08"), dau.where(F.col("dt") <= "2024-01-12")
    for load in (later, earlier, later):
        device_bitmaps.merge(load, path)
    return reduce(DataFrame.unionByName, [device_bitmaps.active_over_days(spark, path, *days) for days in ACTIVE_RANGES])


def q_realtime_hour_response(spark, sf_dir):
    """The endpoint's whole answer as one document."""
    return serving.realtime_hour_response(stored_dau(spark, sf_dir), REPORT_DAY)


def q_dashboard_load(spark, sf_dir):
    """The load of the dashboard's stored tables, which the dashboard queries read: rows per table."""
    base = load_dashboard(spark, sf_dir)
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
              for name, t in (("dau", serving.dau_scan(spark, f"{base}/dau")), ("first_seen", sinks.read_first_seen(spark, f"{base}/first_seen")))]
    return counts[0].unionByName(counts[1])


QUERIES = {
    "active_over_days": q_active_over_days,
    "realtime_hour_response": q_realtime_hour_response,
    "dashboard_load": q_dashboard_load,
    "quarantine_log": q_quarantine_log,
    "dau_upsert": q_dau_upsert,
    "log_parse_dt_hr": q_log_parse_dt_hr,
    "session_starts": q_session_starts,
    "dau_detail": q_dau_detail,
    "dau_incremental": q_dau_incremental,
    "dau_first_seen": q_dau_first_seen,
    "dau_total": q_dau_total,
    "dau_hour_count": q_dau_hour_count,
    "realtime_hour": q_realtime_hour,
    "hourly_compare": q_hourly_compare,
    "realtime_total": q_realtime_total,
    "kpi_compare": q_kpi_compare,
}
