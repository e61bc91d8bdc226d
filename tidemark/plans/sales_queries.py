"""Registered sale-detail and sales-report queries over the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sales
from ..session import ensure_utc, scratch_path
from ..sinks import ranged_table, rollup_store
from ..sources.adapters import line_key
from ..sources.tables import read_table

# Fixed query parameters of the test fixtures.
SALE_DAY = "1995-07-12"
KEYWORD = "ring"
PAGE_START, PAGE_LENGTH = 20, 20


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return read_table(spark, sf_dir, name)


def wide_rows(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    return sales.wide(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"),
                      _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "part"),
                      _t(spark, sf_dir, "nation"), day=day)


def day_rows(spark, sf_dir, keyword=None):
    return sales.filtered(wide_rows(spark, sf_dir, SALE_DAY), SALE_DAY, keyword)


def q_sale_wide(spark, sf_dir):
    return wide_rows(spark, sf_dir)


def q_sale_detail_page(spark, sf_dir):
    return sales.detail_page(day_rows(spark, sf_dir), PAGE_START, PAGE_LENGTH)


def q_sale_keyword_page(spark, sf_dir):
    return sales.detail_page(day_rows(spark, sf_dir, KEYWORD), 0, PAGE_LENGTH)


def q_sale_detail_total(spark, sf_dir):
    return sales.detail_total(day_rows(spark, sf_dir, KEYWORD))


def q_sale_facet_gender(spark, sf_dir):
    return sales.facet_gender(day_rows(spark, sf_dir))


def q_sale_facet_age(spark, sf_dir):
    return sales.facet_age(day_rows(spark, sf_dir))


def q_sale_by_province(spark, sf_dir):
    return sales.by_province(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"),
                             _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"))


def q_sale_by_name(spark, sf_dir):
    return sales.by_name(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))


def q_sale_page_after(spark, sf_dir):
    """The page after the offset page, by key."""
    rows = day_rows(spark, sf_dir)
    last = sales.detail_page(rows, PAGE_START, PAGE_LENGTH).tail(1)
    return sales.detail_page_after(rows, tuple(last[0]) if last else None, PAGE_LENGTH)


# Pages asked of the ranged table, as shares of its length.
DEEP_PAGES = (0.0, 0.37, 0.99, 1.0)


def page_starts(total: int) -> list[int]:
    """Row offsets of ``DEEP_PAGES``; the last one is the last, partial page."""
    return [min(int(share * total), max(0, total - PAGE_LENGTH // 2)) for share in DEEP_PAGES]


def q_sale_page_at(spark, sf_dir):
    """Pages of all wide rows by position, the first, middle and last ones; a fiftieth of the orders are null, and so come first."""
    path = scratch_path(spark, "sale_pages")
    rows = wide_rows(spark, sf_dir)
    rows = rows.withColumn("order_id", F.when(F.col("order_id") % 50 != 0, F.col("order_id")))
    ranged_table.write(rows, path, 16)
    pages = [ranged_table.page_at(spark, path, rows.schema, start, PAGE_LENGTH).withColumn("page", F.lit(i))
             for i, start in enumerate(page_starts(ranged_table.total(spark, path)))]
    return reduce(DataFrame.unionByName, pages)


def q_sale_answer(spark, sf_dir):
    """Total, both facets and a page of one day as JSON documents, from one scan of the lines."""
    return sales.answer(day_rows(spark, sf_dir), PAGE_START, PAGE_LENGTH)


# Groupings of the maintained aggregate.
ROLLUP = ("province", "name")


def line_changes(spark, sf_dir) -> dict[str, DataFrame]:
    """Change batches over the order lines: all inserted; some moved to the next goods at another price; some deleted.

    ``stale`` are updates older than the stored rows.  A line's key is its place in its file.
    """
    li = _t(spark, sf_dir, "lineitem").select(line_key().alias("row_key"), "l_orderkey", "l_partkey", "l_extendedprice")
    places = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey") \
        .join(_t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(_t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    goods = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"))
    # Every batch is of these lines: they meet their places once, into the scratch folder.
    placed = li.join(places, F.col("l_orderkey") == F.col("o_orderkey")).select(*li.columns, F.col("n_name").alias("province"))
    path = scratch_path(spark, "placed_lines")
    placed.write.mode("overwrite").parquet(path)
    li = spark.read.schema(placed.schema).parquet(path)

    def batch(rows, seq: int, kind: str, sku=F.col("l_partkey"), price=F.col("l_extendedprice")):
        own = rows.select("row_key", "province", sku.alias("sku"), price.cast("decimal(18,2)").alias("amount")).join(goods, "sku")
        return own.select("row_key", F.lit(seq).alias("seq"), F.lit(kind).alias("type"), "province", "name", "amount")

    moved = F.when(F.col("l_partkey") > 1, F.col("l_partkey") - 1).otherwise(F.col("l_partkey"))
    return {
        "insert": batch(li, 1, "INSERT"),
        "update": batch(li.where("l_orderkey % 5 = 0"), 3, "UPDATE", moved, F.col("l_extendedprice").cast("decimal(18,2)") + 1),
        "delete": batch(li.where("l_orderkey % 7 = 0"), 4, "DELETE"),
        "stale": batch(li.where("l_orderkey % 3 = 0"), 0, "UPDATE", price=F.lit(0)),
    }


def q_sale_rollup(spark, sf_dir):
    """Lines and amount per province and per goods name, maintained over batches of inserts, updates and deletes.

    The updates come once more after the deletes, and updates older than the rows come last.
    """
    path = scratch_path(spark, "sale_rollup")
    changes = line_changes(spark, sf_dir)
    for name in ("insert", "update", "delete", "update", "stale"):
        rollup_store.merge(changes[name], path, ROLLUP)
    out = rollup_store.read(spark, path, ROLLUP, "string")
    return out.select("grouping", "value", "n", F.col("amount").cast("double").alias("amount"))


QUERIES = {
    "sale_page_after": q_sale_page_after,
    "sale_page_at": q_sale_page_at,
    "sale_answer": q_sale_answer,
    "sale_rollup": q_sale_rollup,
    "sale_wide": q_sale_wide,
    "sale_detail_page": q_sale_detail_page,
    "sale_keyword_page": q_sale_keyword_page,
    "sale_detail_total": q_sale_detail_total,
    "sale_facet_gender": q_sale_facet_gender,
    "sale_facet_age": q_sale_facet_age,
    "sale_by_province": q_sale_by_province,
    "sale_by_name": q_sale_by_name,
}
