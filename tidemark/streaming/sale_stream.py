"""Order lines enriched as a stream: line messages with their order's, user's and goods' fields.

Lines and orders are the fact messages of the change router, on topics of
their own, each with ``at``, the time the message was written.  A line
waits in state for its order, which may come before or after it: a
stream-stream left outer join on the order, within ``reach`` of one
another.  When the watermark has passed a line's reach without an order,
the line goes out with nulls, as in the batch form (``sales.enriched``).
Users and goods are the stored dimension images, joined per micro-batch.

An order's user and day do not change, so the first of its messages
serves; further ones are dropped by a dedup whose memory, ``delay``, is at
least twice ``reach``: a line cannot reach two messages that lie farther
apart, so no line is doubled.  An order that holds a large share of all
lines is spread over ``salt`` state partitions, each with a copy of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..operators import sales
from ..session import ensure_disk_state

COLUMNS = ("order_id", "line_no", "price", "user_id", "dt", "user_name", "sku_id", "sku_name", "sku_brand")


def enriched_stream(lines: DataFrame, orders: DataFrame, images: DataFrame, delay_minutes: int = 120,
                    reach_minutes: int = 60, salt: int = 4) -> DataFrame:
    """One row per line message (columns of ``sales.enriched``).

    ``lines`` and ``orders`` are streams of fact messages (``at``, a variant
    row in ``value``), ``images`` the latest dimension images (static).
    """
    if 2 * reach_minutes > delay_minutes:
        raise ValueError("delay must be twice the reach or more, or a line could meet two messages of its order")
    delay, reach = f"{delay_minutes} minutes", F.expr(f"INTERVAL {reach_minutes} MINUTES")
    li = sales.line_fields(lines.withWatermark("at", delay), "at")
    li = li.withColumn("_salt", F.pmod(F.xxhash64("line_no", "sku_id", "price", "at"), F.lit(salt)))
    o = sales.order_fields(orders.withWatermark("at", delay), "at").where(F.col("order_id").isNotNull())
    o = o.dropDuplicatesWithinWatermark(["order_id"]).withColumnsRenamed({"order_id": "_order", "at": "_at"})
    o = o.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    met = ((F.col("order_id") == F.col("_order")) & (F.col("_salt") == F.col("_copy"))
           & (F.col("_at") >= F.col("at") - reach) & (F.col("_at") <= F.col("at") + reach))
    users, goods = sales.image_fields(images)
    j = li.join(o, met, "left").join(users, F.col("user_id") == F.col("_user"), "left")
    return j.join(goods, F.col("sku_id") == F.col("_sku"), "left").select(*COLUMNS)


def start(lines: DataFrame, orders: DataFrame, images: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
          query_name: str | None = "sale_enriched", **bounds):
    """Start the enrichment into a folder of Parquet files; returns its streaming query."""
    ensure_disk_state(lines.sparkSession)
    return sinks.changelog(enriched_stream(lines, orders, images, **bounds), path, checkpoint, trigger=trigger, query_name=query_name)
