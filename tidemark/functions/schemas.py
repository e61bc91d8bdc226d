"""Declared schemas for the JSON payloads the engine reads.

JSON is schema-on-read in the source systems; here every payload gets a
declared ``StructType`` so ``from_json`` parses only the named fields.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Page log (one app event).  ``ts`` is declared as text and cast later: a
# quoted number read straight as long would turn into null.
COMMON = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("ar", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("vc", T.StringType()),
])
PAGE = T.StructType([T.StructField("last_page_id", T.StringType())])
PAGE_LOG = T.StructType([
    T.StructField("ts", T.StringType()),
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField(CORRUPT, T.StringType()),
])

# DAU detail row, one per (dt, mid).
DAU_INFO = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("ar", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("vc", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("hr", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# First day of each device.
FIRST_SEEN = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("first_dt", T.StringType()),
])

# Change-record envelope.  ``data`` elements differ per table; as variants they
# keep every digit of a number, which a detour over double would lose.
CDC_ENVELOPE = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("pkNames", T.ArrayType(T.StringType())),
    T.StructField("data", T.ArrayType(T.VariantType())),
    T.StructField(CORRUPT, T.StringType()),
])

# Nested document with an object and an array of objects.
PERSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])
MOVIE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("doubanScore", T.DoubleType()),
    T.StructField("directors", PERSON),
    T.StructField("actorList", T.ArrayType(PERSON)),
])

# Kafka source columns; file-backed streams in tests carry the same ones.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
