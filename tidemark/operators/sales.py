"""Sale-detail wide rows, paging, facets and sales by province / by name.

``wide`` is the star join order line -> order -> user -> sku -> province.
Customer and part grow with the data, so their joins carry no broadcast
hint: the planner's size threshold (static estimate, then AQE's runtime
size) decides, and shuffle joins with AQE skew splitting take over beyond
it.  Only the province dimension, a fixed small domain, is broadcast.
A day filter is a range on ``o_orderdate`` that reaches the parquet scan.

The aggregates ``by_province`` and ``by_name`` aggregate the order lines
on the join key *before* each join (eager aggregation).  Counts and sums
distribute over an inner join, so the result equals aggregating the wide
rows, while no shuffle after the first carries line-sized data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import cdc, serving

# Fixed values of the facet and band definitions.
GENDER_FEMALE, GENDER_MALE = "F", "M"
AGE_BANDS = (("under 20", 20), ("20 to 30", 30), ("30 and over", None))
BAND_WIDTH, BAND_TOP = 100, 500

# Day shown when the request names none.
DEFAULT_SALE_DAY = "2019-03-04"

WIDE_COLUMNS = ("order_id", "line_no", "user_id", "sku_id", "user_gender", "user_age",
                "user_level", "sku_price", "sku_name", "sku_tm_id", "province", "dt")


def day_range(col: Column, day: str) -> Column:
    """``col`` within the day ``day`` (a range, so parquet row groups skip)."""
    start = F.lit(day).cast("timestamp_ntz")
    return (col >= start) & (col < start + F.expr("INTERVAL 1 DAY"))


def wide(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame,
         nation: DataFrame, day: str | None = None) -> DataFrame:
    """One wide row per order line with user and sku attributes."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if day is not None:
        o = o.where(day_range(F.col("o_orderdate"), day))
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    c = customer.select("c_custkey", "c_nationkey")
    p = part.select("p_partkey", "p_name", "p_brand")
    n = nation.select("n_nationkey", "n_name")
    # Customer and province are joined at order grain, so that lines are
    # shuffled twice only: by order and by part.
    users = o.join(c.join(n, F.col("c_nationkey") == n.n_nationkey), F.col("o_custkey") == c.c_custkey)
    j = li.join(users, li.l_orderkey == F.col("o_orderkey")).join(p, F.col("l_partkey") == p.p_partkey)
    ck = F.col("c_custkey")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        ck.alias("user_id"),
        F.col("p_partkey").alias("sku_id"),
        F.when(ck % 2 == 0, F.lit(GENDER_FEMALE)).otherwise(F.lit(GENDER_MALE)).alias("user_gender"),
        (F.lit(15) + ck % 30).cast("int").alias("user_age"),
        (F.lit(1) + ck % 10).cast("int").alias("user_level"),
        F.col("l_extendedprice").alias("sku_price"),
        F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("sku_tm_id"),
        F.col("n_name").alias("province"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
    )


def order_fields(orders: DataFrame, *keep: str) -> DataFrame:
    """``order_id, user_id, dt`` of order messages (+ ``keep``)."""
    return orders.select(*keep, cdc.field("id", "bigint").alias("order_id"), cdc.field("user_id", "bigint").alias("user_id"),
                         cdc.field("day", "string").alias("dt"))


def line_fields(lines: DataFrame, *keep: str) -> DataFrame:
    """``order_id, line_no, sku_id, price`` of order-line messages (+ ``keep``)."""
    return lines.select(*keep, cdc.field("order_id", "bigint").alias("order_id"), cdc.field("line_no", "bigint").alias("line_no"),
                        cdc.field("sku_id", "bigint").alias("sku_id"), cdc.field("price", "double").alias("price"))


def image_fields(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``_user, user_name``), (``_sku, sku_name, sku_brand``) of the latest dimension images."""
    def image(table: str, key: str, fields: dict[str, str]) -> DataFrame:
        row = images.where(F.col("dim_table") == table)
        return row.select(F.col("pk").try_cast("bigint").alias(key),
                          *[cdc.field(name, "string").alias(alias) for name, alias in fields.items()])

    return (image("user_info", "_user", {"name": "user_name"}),
            image("sku_info", "_sku", {"name": "sku_name", "brand": "sku_brand"}))


def enriched(lines: DataFrame, orders: DataFrame, images: DataFrame) -> DataFrame:
    """Order lines of the fact feed with order, user and goods fields, one row per line message.

    ``lines`` and ``orders`` are fact messages (a variant row in ``value``; orders
    with ``seq`` and ``pos``), ``images`` the latest dimension images.  A line
    keeps its row, with nulls, where its order or an image is missing.  Orders
    are cut to their last message and joined with their user first, so that
    lines are shuffled twice only: by order and by goods.
    """
    o = (order_fields(orders, "seq", "pos").where(F.col("order_id").isNotNull()).groupBy("order_id")
         .agg(F.max(F.struct("seq", "pos", "user_id", "dt")).alias("_o"))
         .select("order_id", "_o.user_id", "_o.dt"))
    users, goods = image_fields(images)
    o = o.join(users, F.col("user_id") == F.col("_user"), "left").drop("_user")
    j = line_fields(lines).join(o, "order_id", "left").join(goods, F.col("sku_id") == F.col("_sku"), "left")
    return j.select("order_id", "line_no", "price", "user_id", "dt", "user_name", "sku_id", "sku_name", "sku_brand")


def tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens of a goods name or keyword."""
    return F.split(F.lower(F.trim(text)), r"\s+")


def keyword_match(name: Column, keyword: str | None) -> Column:
    """Token match of the goods name; an empty keyword matches everything."""
    if keyword is None or not keyword.strip():
        return F.lit(True)
    return F.arrays_overlap(tokens(name), tokens(F.lit(keyword)))


def filtered(wide_rows: DataFrame, day: str | None, keyword: str | None) -> DataFrame:
    """Rows of one day (default ``DEFAULT_SALE_DAY``) matching the keyword."""
    day = day or DEFAULT_SALE_DAY
    return wide_rows.where((F.col("dt") == F.lit(day)) & keyword_match(F.col("sku_name"), keyword))


def detail_page(rows: DataFrame, start: int, length: int) -> DataFrame:
    """One page of rows in a total order (all columns), ``start`` a row offset."""
    order = [F.col(c).asc_nulls_first() for c in rows.columns]
    return rows.orderBy(*order).offset(start).limit(length)


def detail_page_after(rows: DataFrame, after: tuple | None, length: int) -> DataFrame:
    """Keyset page: the ``length`` rows that follow ``after`` in the total order.

    ``after`` is the last row of the previous page (all columns, in order),
    or None for the first page.  Deep pages cost the same as the first:
    no offset rows are sorted and skipped, each task keeps ``length`` rows.
    Nulls come first in every column, as in the offset form.
    """
    order = [F.col(c).asc_nulls_first() for c in rows.columns]
    if after is not None:
        bound = F.struct(*[F.lit(v).cast(t) for v, (_, t) in zip(after, rows.dtypes)])
        beyond = F.struct(*rows.columns) > bound
        if after[0] is not None:
            first_col, first_type = rows.dtypes[0]
            # Implied by the tuple comparison, and pushable to the scan (row-group skipping).
            beyond = (F.col(first_col) >= F.lit(after[0]).cast(first_type)) & beyond
        rows = rows.where(beyond)
    return rows.orderBy(*order).limit(length)


def detail_total(rows: DataFrame) -> DataFrame:
    """Total hits shown beside a page."""
    return rows.agg(F.count(F.lit(1)).alias("total"))


def _with_share(counts: DataFrame) -> DataFrame:
    # The facet aggregate has at most three rows; one window over it is cheap.
    total = F.sum("value").over(Window.partitionBy())
    return counts.withColumn("share_pct", (F.col("value") * 100).cast("double") / total)


def facet_gender(rows: DataFrame) -> DataFrame:
    """``(name, value, share_pct)`` per gender."""
    counts = rows.groupBy(F.col("user_gender").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    return _with_share(counts)


def age_band(age: Column) -> Column:
    out = F.lit(AGE_BANDS[-1][0])
    for label, upper in reversed(AGE_BANDS[:-1]):
        out = F.when(age < upper, F.lit(label)).otherwise(out)
    return out


def facet_age(rows: DataFrame) -> DataFrame:
    """``(name, value, share_pct)`` per age band."""
    counts = rows.groupBy(age_band(F.col("user_age")).alias("name")) \
                 .agg(F.count(F.lit(1)).alias("value"))
    return _with_share(counts)


def answer(rows: DataFrame, start: int, length: int) -> DataFrame:
    """The dashboard's whole answer for ``filtered`` rows: ``section, body``, each body one JSON document.

    ``total`` is the number of hits, ``gender`` and ``age`` the facets with
    their shares, ``detail`` the page.  The rows are computed once, into
    the shared scratch folder; total and both facets come from one pass with
    grouping sets, the page from another over the stored rows.  Every body
    is bounded: at most three facet values, ``length`` rows.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "sale-answer")
    rows.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    banded = rows.withColumn("_band", age_band(F.col("user_age")))
    counts = banded.groupingSets([[], ["user_gender"], ["_band"]], "user_gender", "_band") \
                   .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("value"))
    total = F.max(F.when(F.col("_set") == 3, F.col("value"))).over(Window.partitionBy())  # at most six rows
    section = F.when(F.col("_set") == 3, "total").when(F.col("_set") == 1, "gender").otherwise("age")
    stats = counts.select(section.alias("section"), F.coalesce("user_gender", "_band").alias("name"), "value",
                          percent_text(F.when(F.col("_set") != 3, F.col("value") * 100 / total)).alias("share"))
    facets = stats.groupBy("section").agg(F.to_json(F.array_sort(F.collect_list(F.struct("name", "value", "share")))).alias("body"))
    # Grouping sets give no row at all for no hits; the sections are there all the same.
    names = spark.range(3).select(F.element_at(F.array(*[F.lit(s) for s in ("total", "gender", "age")]), F.col("id").cast("int") + 1).alias("section"))
    none = F.when(F.col("section") == "total", F.lit('[{"value":0}]')).otherwise("[]")
    facets = names.join(F.broadcast(facets), "section", "left").select("section", F.coalesce("body", none).alias("body"))
    page = serving.json_list(detail_page(rows, start, length), tuple(rows.columns))
    return facets.unionByName(page.select(F.lit("detail").alias("section"), "body"))


def percent_text(share_pct: Column, digits: int = 2) -> Column:
    """Display form ``12.34%`` of a share."""
    return F.concat(F.format_number(share_pct, digits), F.lit("%"))


def value_band(value: Column) -> Column:
    """Lower bound of the 100-wide band, the top band open-ended."""
    return F.least(F.floor(value / BAND_WIDTH) * BAND_WIDTH, F.lit(BAND_TOP)).cast("bigint")


def _lines_per_order(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("amount"))


def by_province(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                nation: DataFrame) -> DataFrame:
    """Sale lines and amount per province, with the map's value band.

    Order lines are joined to the dimensions this report needs (order,
    user, province), each after aggregating on that join's key.
    """
    per_order = _lines_per_order(lineitem)
    per_cust = (per_order.join(orders.select("o_orderkey", "o_custkey"),
                               F.col("l_orderkey") == F.col("o_orderkey"))
                         .groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount")))
    per_nation = (per_cust.join(customer.select("c_custkey", "c_nationkey"),
                                F.col("o_custkey") == F.col("c_custkey"))
                          .groupBy("c_nationkey").agg(F.sum("n").alias("n"),
                                                      F.sum("amount").alias("amount")))
    joined = per_nation.join(nation.select("n_nationkey", "n_name"),
                             F.col("c_nationkey") == F.col("n_nationkey"))
    out = joined.groupBy(F.col("n_name").alias("province")).agg(
        F.sum("n").alias("value"), F.sum("amount").alias("amount"))
    return out.select("province", "value", F.round("amount", 2).alias("amount"),
                      value_band(F.col("value")).alias("band"))


def by_name(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """``(name, num, amount)`` per goods name: order lines joined to the sku only."""
    per_sku = lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("l_extendedprice").alias("amount"))
    joined = per_sku.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    out = joined.groupBy(F.col("p_name").alias("name")).agg(
        F.sum("n").alias("num"), F.sum("amount").alias("amount"))
    return out.select("name", "num", F.round("amount", 2).alias("amount"))
