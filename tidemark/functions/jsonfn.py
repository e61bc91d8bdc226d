"""JSON helpers: typed parse, render, field and element access.

Thin names over built-ins so jobs read like the source system's JSON
calls; every one is a JVM-side expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import CORRUPT


def to_text(col: Column) -> Column:
    """Object / array / map -> JSON text (null fields omitted)."""
    return F.to_json(col)


def parse_typed(text: Column, schema: T.DataType) -> Column:
    """JSON text -> typed value of ``schema`` (nested structs and arrays)."""
    return F.from_json(text, schema)


def parse_dynamic(text: Column) -> Column:
    """JSON text -> VARIANT for payloads without a common schema; bad text -> null."""
    return F.try_parse_json(text)


def field_text(text: Column, name: str) -> Column:
    """String value of a top-level field of JSON text (numbers as text)."""
    return F.get_json_object(text, f"$.{name}")


def variant_field(v: Column, path: str, type_: str = "string") -> Column:
    """Typed field of a VARIANT; null when absent or of another type."""
    return F.try_variant_get(v, path, type_)


def element(arr: Column, index0: int) -> Column:
    """0-based array element, null when out of range."""
    return F.try_element_at(arr, F.lit(index0 + 1))


def parse_once(raw: DataFrame, value_col: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column once per row: ``doc`` (typed) and ``_raw`` (text).

    The parse sits in a one-row ``inline`` generator.  Later filters on
    parsed fields cannot be pushed below a generator, so Catalyst cannot
    inline (and re-run) ``from_json`` once per referenced field.
    Unparsable text gives a null ``doc`` or one carrying ``_corrupt_record``.
    """
    passthrough = [c for c in raw.columns if c != value_col]
    text = F.col(value_col).cast("string")
    doc = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return raw.select(*passthrough, F.inline(F.array(F.struct(doc.alias("doc"), text.alias("_raw")))))


def corrupt_text() -> Column:
    """The raw text of rows ``parse_once`` could not parse as an object, else null.

    A null message (e.g. a Kafka tombstone) is quarantined too, as empty text.
    """
    bad = F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull()
    return F.when(bad, F.coalesce(F.col("_raw"), F.lit("")))
