"""Change-record routing: dimension snapshots and per-operation fact feeds.

A change record is an envelope ``{table, type, pkNames, data[]}``.  Rows
of dimension tables become a keyed changelog whose latest image per key
is the dimension (``dim_rows`` + ``dim_latest``).  Rows of every other
table become messages on ``DWD_<TABLE>_<I|U|D>`` (``route_facts``).

``route_all`` does both in one pass (one explode, every row tagged with
its route), which is what the streaming router uses.

A data row stays a VARIANT from the parse to the edge: keys and fields are
read from it by path, Parquet stores it as it is, and it becomes text only
where a message is sent (``as_text``).  Numbers keep every digit.

All steps are narrow except ``dim_latest``, a partial + final ``max_by``
aggregate per ``(dim_table, pk)``: a key with many images collapses map
side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.jsonfn import corrupt_text, parse_once
from ..functions.schemas import CDC_ENVELOPE, CORRUPT

# The dimension tables and the op-code letters.
DIM_TABLES = ("user_info", "sku_info", "base_province")
OP_INSERT, OP_UPDATE, OP_DELETE = "INSERT", "UPDATE", "DELETE"
OP_CODES = {OP_INSERT: "I", OP_UPDATE: "U", OP_DELETE: "D"}
FACT_TOPIC_PREFIX = "DWD_"
DIM_KEY_PREFIX = "DIM:"

def parse(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Envelope JSON -> ``table, type, pkNames, data`` (data rows are variants)."""
    passthrough = [c for c in raw.columns if c != value_col]
    one = parse_once(raw, value_col, CDC_ENVELOPE)
    return one.select(
        *passthrough,
        F.col("doc.table").alias("table"),
        F.col("doc.type").alias("type"),
        F.col("doc.pkNames").alias("pkNames"),
        F.col("doc.data").alias("data"),
        corrupt_text().alias(CORRUPT),
    )


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull())


def rejects(parsed: DataFrame, dims: Sequence[str] = DIM_TABLES) -> DataFrame:
    """All that routing leaves out, with its ``fault`` (+ passthrough columns, e.g. ``seq``).

    ``json``: not an envelope; ``table``: no table name; ``type``: a fact of
    another operation; ``pk_names``: a dimension envelope without key
    columns; ``pk``: a dimension row whose first key value is null;
    ``data``: an envelope without rows.
    """
    keep = [c for c in parsed.columns if c not in ("table", "type", "pkNames", "data", CORRUPT)]
    is_dim = is_dimension(F.col("table"), dims)
    whole = (F.when(F.col(CORRUPT).isNotNull(), "json").when(F.col("table").isNull(), "table")
             .when(~is_dim & op_code(F.col("type")).isNull(), "type")
             .when(is_dim & (F.col("pkNames").isNull() | (F.size("pkNames") == 0)), "pk_names")
             .when(F.col("data").isNull() | (F.size("data") == 0), "data"))
    # Envelopes at fault go as one text; rows of dimension envelopes are looked into, facts are not.
    text = F.when(whole.isNotNull(), F.coalesce(F.col(CORRUPT), F.to_json(F.struct("table", "type", "pkNames", "data"))))
    rows = parsed.where(whole.isNotNull() | is_dim).select(
        *keep, "table", "pkNames", whole.alias("fault"), text.alias("_text"),
        F.explode_outer(F.when(whole.isNull(), F.col("data"))).alias("value"))
    keyed = _with_pk(rows, first_pk())
    return keyed.withColumn("fault", F.coalesce("fault", F.when(F.col("pk").isNull(), "pk"))) \
                .where(F.col("fault").isNotNull()) \
                .select(*keep, "table", "fault", F.coalesce("_text", as_text("value")).alias("value"))


def is_dimension(table: Column, dims: Sequence[str] = DIM_TABLES) -> Column:
    """Null-safe membership: a null table is not a dimension."""
    return F.coalesce(table.isin(*dims), F.lit(False))


def split(parsed: DataFrame, dims: Sequence[str] = DIM_TABLES) -> tuple[DataFrame, DataFrame]:
    """(dimension side, fact side) of a parsed change stream."""
    dim = is_dimension(F.col("table"), dims)
    return parsed.where(dim), parsed.where(~dim)


def op_code(type_col: Column) -> Column:
    """INSERT/UPDATE/DELETE -> I/U/D; any other type -> null (dropped)."""
    out = F.lit(None).cast("string")
    for name, code in reversed(list(OP_CODES.items())):
        out = F.when(type_col == F.lit(name), F.lit(code)).otherwise(out)
    return out


def fact_topic(table: Column, op: Column) -> Column:
    return F.concat(F.lit(FACT_TOPIC_PREFIX), F.upper(table), F.lit("_"), op)


def route_facts(facts: DataFrame) -> DataFrame:
    """One message per data row: ``topic`` + ``value`` (the row, a variant) + ``pos``.

    Rows with an unknown type or a null table are dropped, as are
    envelopes without data.  Other columns (e.g. ``seq``) pass through.
    """
    keep = [c for c in facts.columns if c not in ("table", "type", "pkNames", "data")]
    op = op_code(F.col("type"))
    routed = facts.where(op.isNotNull() & F.col("table").isNotNull()) \
                  .select(*keep, fact_topic(F.col("table"), op).alias("topic"),
                          F.posexplode("data").alias("pos", "value"))
    return routed.select(*keep, "topic", F.col("pos").cast("bigint").alias("pos"), "value")


def as_text(value: str | Column = "value") -> Column:
    """JSON text of a data row, for a message or a file that has to be text."""
    return F.to_json(value)


def field(name: str, type_: str, value: str | Column = "value") -> Column:
    """Typed field of a data row; null where it is absent or of another type."""
    return F.try_variant_get(value, f"$.{name}", type_)


def _key_path(name: Column) -> Column:
    """Path of a top-level field: quoted, so dots in a name are no path; null for a name with both kinds of quotes."""
    single, double = name.contains("'"), name.contains('"')
    return (F.when(~single, F.concat(F.lit("$['"), name, F.lit("']")))
            .when(~double, F.concat(F.lit('$["'), name, F.lit('"]'))))


def _key_part(name: Column) -> Column:
    return F.try_variant_get("value", _key_path(name), "string")


def first_pk() -> Column:
    """Value of the first pk column as text."""
    return _key_part(F.try_element_at("pkNames", F.lit(1)))


def full_pk() -> Column:
    """All pk values joined by ``:``; null when any is null.

    ``\\`` and ``:`` inside a value are escaped, so different keys stay different.
    """
    parts = F.transform("pkNames", lambda n: F.regexp_replace(_key_part(n), r"([\\:])", r"\\$1"))
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, ":"))


def _with_pk(rows: DataFrame, pk: Column) -> DataFrame:
    """``rows`` with their key as ``pk``, looked up once.

    The key comes out of a one-row generator, so that filters and columns on
    it read its result; Catalyst would put the lookup into each of them.
    """
    rest = [c for c in rows.columns if c != "value"]
    return rows.select(*rest, F.inline(F.array(F.struct("value", pk.alias("pk")))))


def dim_rows(dims: DataFrame, full_key: bool = False,
             observation: Observation | None = None) -> DataFrame:
    """Dimension changelog: ``dim_table, pk, dim_key, type, pos, value`` (+ passthrough).

    Envelopes without ``pkNames`` are skipped (the source did the same);
    an empty ``pkNames`` or a row whose pk value is null cannot be keyed
    and is left out too (see ``dim_rows_rejected``, ``dim_rows_null_pk``).
    With ``observation``, the data rows left out are counted during the
    job that consumes the result (``no_pk_names``, ``empty_pk_names``,
    ``null_pk``).  ``full_key`` joins every pk column into the key instead
    of the first one only.
    """
    keep = [c for c in dims.columns if c not in ("table", "type", "pkNames", "data")]
    rows = dims if observation is not None else \
        dims.where(F.col("pkNames").isNotNull() & (F.size("pkNames") > 0))
    exploded = rows.select(*keep, F.col("table").alias("dim_table"), "type", "pkNames",
                           F.posexplode("data").alias("pos", "value"))
    out = _with_pk(exploded, full_pk() if full_key else first_pk())
    out = out.select(*keep, "dim_table", "pk", "type", "pkNames", F.col("pos").cast("bigint").alias("pos"), "value")
    if observation is not None:
        no_names = F.col("pkNames").isNull()
        empty = F.size("pkNames") == 0
        out = out.observe(
            observation,
            F.count(F.when(no_names, 1)).alias("no_pk_names"),
            F.count(F.when(~no_names & empty, 1)).alias("empty_pk_names"),
            F.count(F.when(~no_names & ~empty & F.col("pk").isNull(), 1)).alias("null_pk"))
    out = out.where(F.col("pk").isNotNull()).drop("pkNames")
    return out.withColumn("dim_key", F.concat(F.lit(DIM_KEY_PREFIX), F.upper("dim_table"),
                                              F.lit(":"), F.col("pk")))


DIM_TOPIC_PREFIX = "DIM_"
ROUTED_COLUMNS = ("route", "dim_table", "pk", "dim_key", "type", "pos", "value", "msg_key")


def route_all(parsed: DataFrame, dims: Sequence[str] = DIM_TABLES, full_key: bool = False) -> DataFrame:
    """Both arms in one pass: every data row with its ``route``.

    Dimension images get ``route = DIM_<TABLE>`` plus ``pk`` / ``dim_key``
    (same rules as ``dim_rows``); fact rows get ``route = DWD_<TABLE>_<op>``
    (same rules as ``route_facts``).  One explode, no union, so a stream
    reads and parses its source once and commits both outputs together.
    Other input columns (e.g. ``seq``) pass through.
    """
    keep = [c for c in parsed.columns if c not in ("table", "type", "pkNames", "data")]
    is_dim = is_dimension(F.col("table"), dims)
    op = op_code(F.col("type"))
    usable = F.when(is_dim, F.col("pkNames").isNotNull() & (F.size("pkNames") > 0)) \
              .otherwise(op.isNotNull() & F.col("table").isNotNull())
    rows = parsed.where(usable).select(
        *keep, "table", "type", "pkNames", is_dim.alias("_dim"), op.alias("_op"),
        F.posexplode("data").alias("pos", "value"))
    rows = _with_pk(rows, full_pk() if full_key else first_pk()).withColumnRenamed("pk", "_pk")
    rows = rows.where(~F.col("_dim") | F.col("_pk").isNotNull()).withColumn("pk", F.when(F.col("_dim"), F.col("_pk")))
    route = F.when(F.col("_dim"), F.concat(F.lit(DIM_TOPIC_PREFIX), F.upper("table"))) \
             .otherwise(fact_topic(F.col("table"), F.col("_op")))
    dim_key = F.when(F.col("_dim"), F.concat(F.lit(DIM_KEY_PREFIX), F.upper("table"), F.lit(":"), F.col("pk")))
    # Message key: the dimension key, or a fact's own pk when the envelope
    # names one, so one key's changes stay in one Kafka partition, in order.
    msg_key = F.when(F.col("_dim"), dim_key).otherwise(F.col("_pk"))
    return rows.select(
        *keep, route.alias("route"),
        F.when(F.col("_dim"), F.col("table")).alias("dim_table"),
        "pk", dim_key.alias("dim_key"), "type",
        F.col("pos").cast("bigint").alias("pos"), "value", msg_key.alias("msg_key"))


def dim_log_of(routed: DataFrame) -> DataFrame:
    """The dimension changelog part of ``route_all`` output."""
    return routed.where(F.col("route").startswith(DIM_TOPIC_PREFIX)).drop("route", "msg_key")


def facts_of(routed: DataFrame) -> DataFrame:
    """The fact-message part of ``route_all`` output, as ``topic`` + ``value``."""
    return (routed.where(F.col("route").startswith(FACT_TOPIC_PREFIX))
                  .withColumnRenamed("route", "topic")
                  .drop("dim_table", "pk", "dim_key", "type", "msg_key"))


def dim_rows_null_pk(dims: DataFrame) -> DataFrame:
    """Dimension data rows whose first pk value is null (cannot be keyed)."""
    keep = [c for c in dims.columns if c not in ("table", "type", "pkNames", "data")]
    keyed = dims.where(F.col("pkNames").isNotNull() & (F.size("pkNames") > 0))
    rows = keyed.select(*keep, F.col("table").alias("dim_table"), "type", "pkNames",
                        F.posexplode("data").alias("pos", "value"))
    return rows.where(first_pk().isNull()).drop("pkNames")


def dim_rows_rejected(dims: DataFrame) -> DataFrame:
    """Dimension envelopes that cannot be keyed (no or empty ``pkNames``)."""
    return dims.where(F.col("pkNames").isNull() | (F.size("pkNames") == 0))


def dim_latest(dim_log: DataFrame, order: Sequence[str] = ("seq", "pos"),
               deletes: str = "keep", keep: Sequence[str] = ()) -> DataFrame:
    """Latest image per ``(dim_table, pk)``: last write wins by ``order``.

    ``keep`` names columns that the key determines.  ``deletes="keep"`` stores a DELETE's old image like any write (the
    source system's behaviour); ``deletes="apply"`` removes such keys.
    """
    missing = [c for c in order if c not in dim_log.columns]
    if missing:
        raise ValueError(f"dim_latest orders images by {list(order)}; missing {missing}: "
                         "carry the log position (e.g. seq) through parse")
    payload = [c for c in ("dim_key", "type", "value") if c in dim_log.columns]
    # A position names one data row, so only copies of it can tie; rows kept as text are ordered by it too.
    tie = [c for c in payload if c != "value" or dict(dim_log.dtypes)["value"] == "string"]
    last = F.max_by(F.struct(*order, *payload), F.struct(*order, *tie)).alias("_last")
    latest = dim_log.groupBy("dim_table", "pk", *keep).agg(last) \
                    .select("dim_table", "pk", *keep, *[F.col(f"_last.{c}").alias(c) for c in (*order, *payload)])
    if deletes == "apply":
        latest = latest.where(F.col("type") != F.lit(OP_DELETE))
    elif deletes != "keep":
        raise ValueError("deletes must be 'keep' or 'apply'")
    return latest


def merge_latest(snapshot: DataFrame | None, changes: DataFrame,
                 order: Sequence[str] = ("seq", "pos"), deletes: str = "keep") -> DataFrame:
    """Compaction step: previous latest-image snapshot + new changelog rows.

    Both inputs have the ``dim_latest`` columns (``dim_rows`` output for the
    changes); the result is the new snapshot, to be written as a new version
    folder.  Equal to ``dim_latest`` over the whole changelog.
    """
    cols = ["dim_table", "pk", *order, "dim_key", "type", "value"]
    merged = changes.select(*cols)
    if snapshot is not None:
        merged = snapshot.select(*cols).unionByName(merged)
    return dim_latest(merged, order, deletes)


def snapshot_envelopes(tables: Mapping[str, DataFrame], pk_names: Sequence[str] = ("id",),
                       type_: str = OP_INSERT) -> DataFrame:
    """Bootstrap snapshot: one INSERT envelope per source row, all tables unioned.

    The source system sent one envelope per table holding every row; one
    envelope per row carries the same rows after ``posexplode`` and keeps
    every message bounded whatever the table size.  ``key`` is the
    dimension key: sent as the message key it keeps a row's images in one
    partition, in order.
    """
    frames = []
    for name, df in tables.items():
        key = F.concat(F.lit(f"{DIM_KEY_PREFIX}{name.upper()}:"), F.col(pk_names[0]).cast("string"))
        frames.append(df.select(key.alias("key"), F.to_json(F.struct(
            F.array(F.struct(*df.columns)).alias("data"),
            F.lit(name).alias("table"),
            F.lit(type_).alias("type"),
            F.array(*[F.lit(p) for p in pk_names]).alias("pkNames"),
        )).alias("value")))
    return reduce(DataFrame.unionByName, frames)
