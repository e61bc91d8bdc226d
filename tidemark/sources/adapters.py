"""Adapters that present the warehouse tables as the source systems' records.

The engine's inputs are JSON page logs and JSON change records (one
document per message).  The test warehouse holds plain tables, so these
adapters render those tables as the messages the jobs consume; the
mapping is fixed in FIXTURES.md §2.  All are narrow projections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc
from .tables import read_table

# Sequence layout: seq = key (order lines: position) * 10 + part code, unique per message.
SEQ_ORDER_INFO, SEQ_ORDER_DETAIL = 0, 1
SEQ_USER_INSERT, SEQ_USER_UPDATE, SEQ_USER_DELETE = 2, 3, 4
SEQ_SKU, SEQ_PROVINCE = 5, 6


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> ``(event_id, value)`` where value is the page-log JSON text."""
    ensure_utc(spark)
    return raw_log_from(read_table(spark, sf_dir, "events"))


def raw_log_from(ev: DataFrame) -> DataFrame:
    """Page-log rendering of an ``events`` frame (batch or streaming)."""
    k = _k(F.col("props"))
    user = F.col("user_id").cast("string")
    common = F.struct(
        user.alias("mid"),
        user.alias("uid"),
        (F.col("user_id") % 34).cast("string").alias("ar"),
        F.col("event_type").alias("ch"),
        F.concat(F.lit("v2.1."), (k % 5).cast("string")).alias("vc"),
    )
    last_page = (F.when(k % 10 < 3, F.lit(None).cast("string"))
                 .when(k % 10 == 3, F.lit(""))
                 .otherwise(F.concat(F.lit("page_"), k.cast("string"))))
    page = F.when(F.col("event_type") == "error", F.lit(None)) \
            .otherwise(F.struct(last_page.alias("last_page_id")))
    value = F.to_json(F.struct(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        common.alias("common"),
        page.alias("page"),
    ))
    return ev.select("event_id", value.alias("value"))


def _envelope(table: str, type_: Column, pk_names: Column, data: Column) -> Column:
    return F.to_json(F.struct(
        F.lit(table).alias("table"),
        type_.alias("type"),
        pk_names.alias("pkNames"),
        data.alias("data"),
    ))


def _id_pk() -> Column:
    return F.array(F.lit("id"))


def cdc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log ``(seq, value)`` built from the warehouse tables (FIXTURES.md §2.2)."""
    ensure_utc(spark)
    orders = read_table(spark, sf_dir, "orders")
    status_type = (F.when(F.col("o_orderkey") % 97 == 0, F.lit("QUERY"))
                   .when(F.col("o_orderstatus") == "F", F.lit("INSERT"))
                   .when(F.col("o_orderstatus") == "O", F.lit("UPDATE"))
                   .when(F.col("o_orderstatus") == "P", F.lit("DELETE")))

    def order_row(total: Column) -> Column:
        return F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            total.alias("total"),
            F.col("o_orderstatus").alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        )

    # An update carries two rows, so that envelopes of several rows are covered.
    first, second = order_row(F.col("o_totalprice")), order_row(F.col("o_totalprice") + 1)
    order_rows = F.when(F.col("o_orderstatus") == "O", F.array(first, second)).otherwise(F.array(first))
    order_info = orders.select(
        (F.col("o_orderkey") * 10 + SEQ_ORDER_INFO).alias("seq"),
        _envelope("order_info", status_type, _id_pk(), order_rows).alias("value"),
    )

    order_detail = order_detail_envelopes(read_table(spark, sf_dir, "lineitem"))

    # All images of a customer (insert; update for even keys; delete for
    # keys = 1 mod 50) come from one scan, one row per image.
    cust = read_table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")

    def image(code: int, type_: str, pk_names: Column, balance: Column) -> Column:
        return F.struct((ck * 10 + code).alias("seq"), F.lit(type_).alias("type"),
                        pk_names.alias("pkNames"), balance.alias("balance"))

    images = F.array(
        image(SEQ_USER_INSERT, "INSERT",
              F.when(ck % 100 == 0, F.lit(None).cast("array<string>")).otherwise(_id_pk()),
              F.col("c_acctbal")),
        F.when(ck % 2 == 0, image(SEQ_USER_UPDATE, "UPDATE", _id_pk(), F.col("c_acctbal") + 1)),
        F.when(ck % 50 == 1, image(SEQ_USER_DELETE, "DELETE", _id_pk(), F.col("c_acctbal"))),
    )
    per_image = cust.select("c_custkey", "c_name", "c_mktsegment",
                            F.explode(F.filter(images, lambda x: x.isNotNull())).alias("img"))
    user_info = per_image.select(
        F.col("img.seq").alias("seq"),
        _envelope("user_info", F.col("img.type"), F.col("img.pkNames"), F.array(F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"), F.col("img.balance").alias("balance")))
        ).alias("value"))

    part = read_table(spark, sf_dir, "part")
    sku = part.select(
        (F.col("p_partkey") * 10 + SEQ_SKU).alias("seq"),
        _envelope("sku_info", F.lit("INSERT"), _id_pk(), F.array(F.struct(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
            F.col("p_retailprice").alias("price")))).alias("value"))

    nation = read_table(spark, sf_dir, "nation")
    province = nation.select(
        (F.col("n_nationkey").cast("bigint") * 10 + SEQ_PROVINCE).alias("seq"),
        _envelope("base_province", F.lit("INSERT"), _id_pk(), F.array(F.struct(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("region")))).alias("value"))

    parts = [order_info, order_detail, user_info, sku, province]
    return reduce(DataFrame.unionByName, parts)


def line_position() -> Column:
    """Place of a row in its table as a number: 31 bits of its file's name, 28 of its row number in the file.

    So ``* 10 + code`` fits 64 bits, and two of 5,000 files share a code in 6 of 1,000 tables.
    """
    return F.xxhash64(F.col("_metadata.file_name")).bitwiseAND(0x7FFFFFFF) * (1 << 28) + F.col("_metadata.row_index")


def line_key() -> Column:
    """Name of a row's place in its table: no two rows share it."""
    return F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))


def order_detail_envelopes(lineitem: DataFrame) -> DataFrame:
    """One INSERT envelope per order line: a narrow projection of the scan.

    ``seq`` is the line's position in the table (file name and row index),
    so it is unique however many lines, or copies of a line, an order has.
    """
    line = F.struct(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
    )
    return lineitem.select(
        (line_position() * 10 + SEQ_ORDER_DETAIL).alias("seq"),
        _envelope("order_detail", F.lit("INSERT"), F.lit(None).cast("array<string>"), F.array(line)).alias("value"),
    )


def dimension_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The relational dimension tables as the source database holds them."""
    return {
        "user_info": read_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")),
        "sku_info": read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
            F.col("p_retailprice").alias("price")),
        "base_province": read_table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("region")),
    }
