"""Registered change-record queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, sales
from ..session import scratch_path
from ..sinks import changelog, dim_store
from ..sources.adapters import cdc_raw, dimension_tables
from ..sources.tables import read_table
from ..streaming.cdc_stream import read_routed


def parsed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.valid(cdc.parse(cdc_raw(spark, sf_dir)))


def fact_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, facts = cdc.split(parsed_changes(spark, sf_dir))
    return cdc.route_facts(facts)


def dim_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims, _ = cdc.split(parsed_changes(spark, sf_dir))
    return cdc.dim_rows(dims)


def q_cdc_route_facts(spark, sf_dir):
    msgs = fact_messages(spark, sf_dir)
    return msgs.select("topic", "pos", cdc.field("line_no", "bigint").alias("line_no"),
                       F.coalesce(cdc.field("id", "bigint"), cdc.field("order_id", "bigint")).alias("record_id"),
                       F.coalesce(cdc.field("total", "double"), cdc.field("price", "double")).alias("amount"))


def q_cdc_route_counts(spark, sf_dir):
    return fact_messages(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def q_dim_latest_counts(spark, sf_dir):
    latest = cdc.dim_latest(dim_log(spark, sf_dir))
    return latest.groupBy("dim_table").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count(F.when(F.col("type") == cdc.OP_UPDATE, 1)).alias("n_updated"),
        F.count(F.when(F.col("type") == cdc.OP_DELETE, 1)).alias("n_deleted"),
    )


def q_dim_latest_rows(spark, sf_dir):
    return _image_fields(cdc.dim_latest(dim_log(spark, sf_dir)))


def _image_fields(latest: DataFrame) -> DataFrame:
    return latest.select(
        "dim_key", "dim_table", "pk", F.col("type").alias("latest_type"), "seq",
        cdc.field("name", "string").alias("name"), cdc.field("balance", "double").alias("balance"),
    )


def q_dim_live_keys(spark, sf_dir):
    """Latest images with deletes applied: keys whose last change is a DELETE drop out."""
    latest = cdc.dim_latest(dim_log(spark, sf_dir), deletes="apply")
    return latest.groupBy("dim_table").agg(F.count(F.lit(1)).alias("n_live"))


def q_cdc_routes(spark, sf_dir):
    """One-pass routing of the whole change log: rows per route (topic)."""
    routed = cdc.route_all(parsed_changes(spark, sf_dir))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def q_cdc_message_keys(spark, sf_dir):
    """Messages per route and how many carry a key (dimension key or the fact's own pk)."""
    routed = cdc.route_all(parsed_changes(spark, sf_dir))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"),
                                       F.count("msg_key").alias("keyed"))


def q_snapshot_envelopes(spark, sf_dir):
    """Bootstrap snapshot round trip: envelopes -> parse -> dimension rows."""
    env = cdc.snapshot_envelopes(dimension_tables(spark, sf_dir))
    rows = cdc.dim_rows(cdc.valid(cdc.parse(env)))
    return rows.select("dim_table", "type", "dim_key",
                       cdc.field("name", "string").alias("name"))


def q_dim_compact(spark, sf_dir):
    """The dimension store after its changelog came in two parts, out of order, each compacted."""
    base = scratch_path(spark, "dim_compact")
    dim_log(spark, sf_dir).write.parquet(f"{base}/all")
    log = spark.read.parquet(f"{base}/all")
    late = F.col("seq") % 3 == 0
    for part in (log.where(~late), log.where(late)):
        changelog(part, f"{base}/log")
        dim_store.compact(spark, f"{base}/log", f"{base}/store")
    dim_store.compact(spark, f"{base}/log", f"{base}/store")  # nothing new: no bucket is touched
    return _image_fields(dim_store.read_images(spark, f"{base}/store"))


def q_sale_enriched(spark, sf_dir):
    """Order lines of the fact feed with the stored images of their user and goods."""
    base = scratch_path(spark, "sale_enriched")
    cdc.route_all(parsed_changes(spark, sf_dir)).write.partitionBy("route").parquet(f"{base}/routed")
    dim_store.compact(spark, f"{base}/routed", f"{base}/store", pick=cdc.dim_log_of)
    routed = read_routed(spark, f"{base}/routed")
    lines = routed.where(F.col("route") == "DWD_ORDER_DETAIL_I")
    orders = routed.where(F.col("route").startswith("DWD_ORDER_INFO_"))
    return sales.enriched(lines, orders, dim_store.read_images(spark, f"{base}/store"))


def q_cdc_payload_exact(spark, sf_dir):
    """Money values of 20 digits through parse, explode and routing."""
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    text = F.concat(F.lit('{"table":"order_info","type":"INSERT","pkNames":["id"],"data":[{"id":'), key,
                    F.lit(',"total":9'), F.lpad(key, 17, "0"), F.lit(".89}]}"))
    msgs = cdc.facts_of(cdc.route_all(cdc.valid(cdc.parse(orders.select(text.alias("value"))))))
    return msgs.select(cdc.field("id", "bigint").alias("record_id"),
                       F.regexp_extract(cdc.as_text(), '"total":([^,}]+)', 1).alias("total"))


def q_dim_full_key(spark, sf_dir):
    """Rows per full key: values that hold the separator, a dotted key name, null parts."""
    part = read_table(spark, sf_dir, "part")
    brand = F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand"))
    name = F.concat(F.split("p_name", " ")[0], F.lit(":\\"), (F.col("p_partkey") % 7).cast("string"))
    text = F.to_json(F.struct(
        F.lit("sku_info").alias("table"), F.lit("INSERT").alias("type"),
        F.array(F.lit("brand"), F.lit("sku.name")).alias("pkNames"),
        F.array(F.struct(brand.alias("brand"), name.alias("sku.name"))).alias("data")))
    rows = cdc.dim_rows(cdc.valid(cdc.parse(part.select(text.alias("value")))), full_key=True)
    return rows.groupBy("dim_key").agg(F.count(F.lit(1)).alias("n"))


def q_quarantine_cdc(spark, sf_dir):
    """All that routing leaves out: table, reason, number."""
    left = cdc.rejects(cdc.parse(cdc_raw(spark, sf_dir)))
    return left.groupBy("table", "fault").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "quarantine_cdc": q_quarantine_cdc,
    "cdc_route_facts": q_cdc_route_facts,
    "cdc_route_counts": q_cdc_route_counts,
    "dim_latest_counts": q_dim_latest_counts,
    "dim_latest_rows": q_dim_latest_rows,
    "dim_live_keys": q_dim_live_keys,
    "cdc_routes": q_cdc_routes,
    "cdc_message_keys": q_cdc_message_keys,
    "snapshot_envelopes": q_snapshot_envelopes,
    "dim_compact": q_dim_compact,
    "sale_enriched": q_sale_enriched,
    "cdc_payload_exact": q_cdc_payload_exact,
    "dim_full_key": q_dim_full_key,
}
