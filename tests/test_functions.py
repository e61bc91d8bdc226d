"""Scalar helpers on literal inputs."""

from pyspark.sql import functions as F

from tidemark.functions import jsonfn, timefn
from tidemark.operators import sales

MS = 1704067432824  # 2024-01-01 00:03:52.824 UTC


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_time_helpers(spark):
    ts = timefn.millis_to_ts(F.lit(MS))
    r = _one(spark, timefn.day_text(ts).alias("d"), timefn.hour_text(ts).alias("h"),
             timefn.day_hour_parts(ts).alias("p"),
             timefn.parse_day(F.lit("2020-13-01")).alias("bad"),
             timefn.parse_day(F.lit("2020-03-01")).alias("good"),
             timefn.previous_day("2020-03-01").alias("prev"))
    assert (r.d, r.h, r.p) == ("2024-01-01", "00", ["2024-01-01", "00"])
    assert r.bad is None and str(r.good) == "2020-03-01"
    assert r.prev == "2020-02-29"


def test_now_is_constant_within_a_query(spark):
    df = spark.range(1000).select(timefn.now_millis().alias("t"))
    assert df.select(F.countDistinct("t")).first()[0] == 1


def test_to_long(spark):
    df = spark.createDataFrame([("1704067432824",), (" 42 ",), ("4.5",), ("1.7E12",), ("x",), (None,)],
                               "s string")
    got = [r.v for r in df.select(timefn.to_long(F.col("s")).alias("v")).collect()]
    assert got == [1704067432824, 42, 4, 1700000000000, None, None]


def test_json_helpers(spark):
    text = F.lit('{"a":{"b":[{"id":"1"},{"id":"2"}]},"n":7}')
    r = _one(spark,
             jsonfn.field_text(text, "n").alias("n"),
             jsonfn.element(F.array(F.lit(1), F.lit(2)), 1).alias("second"),
             jsonfn.element(F.array(F.lit(1)), 5).alias("missing"),
             jsonfn.variant_field(jsonfn.parse_dynamic(text), "$.a.b[1].id").alias("vid"),
             jsonfn.parse_dynamic(F.lit("{bad")).alias("bad"),
             jsonfn.to_text(F.create_map(F.lit("20"), F.lit(1), F.lit("3"), F.lit(1))).alias("m"))
    assert r.n == "7" and r.second == 2 and r.missing is None
    assert r.vid == "2" and r.bad is None
    assert r.m == '{"20":1,"3":1}'


def test_percent_text_and_bands(spark):
    r = _one(spark, sales.percent_text(F.lit(12.345)).alias("p"),
             sales.value_band(F.lit(57)).alias("b0"), sales.value_band(F.lit(432)).alias("b4"),
             sales.value_band(F.lit(9999)).alias("top"),
             sales.age_band(F.lit(19)).alias("a1"), sales.age_band(F.lit(20)).alias("a2"),
             sales.age_band(F.lit(30)).alias("a3"))
    assert r.p == "12.35%"
    assert (r.b0, r.b4, r.top) == (0, 400, 500)
    assert (r.a1, r.a2, r.a3) == ("under 20", "20 to 30", "30 and over")


def test_keyword_match(spark):
    df = spark.createDataFrame([("small ring",), ("Ring Gear",), ("spring",)], "n string")
    got = [r.m for r in df.select(sales.keyword_match(F.col("n"), "RING").alias("m")).collect()]
    assert got == [True, True, False]
    assert all(r.m for r in df.select(sales.keyword_match(F.col("n"), " ").alias("m")).collect())
