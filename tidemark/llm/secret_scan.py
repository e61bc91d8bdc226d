"""Secret scan with DataFrame functions only: three patterns and a character Markov model.

Base findings are the leftmost non-overlapping matches of three
patterns.  The model adds findings: every run of token characters is
scored by the log-likelihood ratio of two first-order character chains,
one of random strings and one of ordinary identifiers, and is a finding
when the ratio reaches a threshold.  Chains are trained from labelled
samples (``token``, ``label``).  ``labelled_samples`` makes a table of
them that owes nothing to the patterns: random strings of the usual
alphabets and lengths, and the words of a bounded number of documents,
alone and put together as identifiers are.  A model is one number per
pair of characters.

Positions come from the text between matches (``split``) and the matches
themselves, summed up in chunks, so that a long text stays linear.
No stage but the training's counts shuffles.

Defined results: a null text is empty and has no finding; rows are
scanned each, also repeated ones or such without doc_id; without samples
of either label the model adds nothing (documents without words give no
ordinary ones); no rows give no rows; extra columns are ignored by ``scan`` and kept by ``masked``.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents_of, free_name, share_of

# The contract's patterns, with the letters of the first in either case.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,}"
SIZE = len(ALPHABET) + 1  # and any other character
MASK = "[SECRET]"
_CHUNK = 512


# The greedy runs of the last two are findings only from a length on; asking for that
# length in the pattern gives the same runs and skips the rest early.
_LONG = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}", "assign": ASSIGN, "markov": TOKEN}


def _matches(text: Column, kind: str) -> Column:
    """array<struct<gap, text, keep>>: the text before each match is ``gap`` characters long."""
    pattern = _LONG[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == "assign" else found
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    zipped = F.zip_with(F.slice(gaps, 1, F.size(found)), F.arrays_zip(found.alias("m"), value.alias("v")),
                        lambda g, m: F.struct(g.alias("gap"), m["m"].alias("text"),
                                              (F.length(m["v"]) >= 6).alias("keep")))
    return F.when(F.regexp_like(text, F.lit(pattern)), zipped)


def _located(steps: Column) -> Column:
    """array<struct<start, end, text>> of the kept matches, in code points."""
    def walk(chunk):
        empty = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
        return F.aggregate(chunk, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")), lambda a, s: F.struct(
            (a["at"] + s["gap"] + F.length(s["text"])).alias("at"),
            F.when(s["keep"], F.concat(a["out"], F.array(F.struct(
                (a["at"] + s["gap"]).alias("start"), (a["at"] + s["gap"] + F.length(s["text"])).alias("end"),
                s["text"].alias("text"))))).otherwise(a["out"]).alias("out")))

    starts = F.sequence(F.lit(1), F.size(steps), F.lit(_CHUNK))
    return F.transform(starts, lambda i: walk(F.slice(steps, i, _CHUNK)))


def _shifted(chunks: Column) -> Column:
    """The chunks' findings at their places in the text."""
    def one(chunk, i):
        before = F.aggregate(F.slice(chunks["at"], 1, i), F.lit(0).cast("long"), lambda a, n: a + n)
        return F.element_at(F.transform(F.array(before), lambda b: F.transform(chunk["out"], lambda s: F.struct(
            (s["start"] + b).alias("start"), (s["end"] + b).alias("end"), s["text"].alias("text")))), 1)

    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    return F.coalesce(F.when(chunks.isNotNull(), F.flatten(F.transform(chunks, one))), none)


def _code(char: Column) -> Column:
    """Place of a character in the alphabet from 1, 0 for any other."""
    return F.call_function("instr", F.lit(ALPHABET), char)


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of neighbouring characters."""
    codes = F.transform(F.filter(F.split(token, "", -1), lambda c: c != ""), _code)
    return F.element_at(F.transform(F.array(codes), lambda c: F.zip_with(
        F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))),
        lambda a, b: a * SIZE + b)), 1)


def random_strings(spark: SparkSession, n: int) -> DataFrame:
    """``n`` random strings (token), the same in every run: base62, base64, its URL form, hex and UUIDs.

    20 to 64 characters each, but for the UUIDs, all taken from hashes of the row's number.
    """
    rows = spark.range(n).select("id", F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 512).alias("hex"))
    base64 = F.base64(F.unhex("hex"))
    size = F.pmod(F.xxhash64("id"), F.lit(45)).cast("int") + 20

    def cut(text: Column) -> Column:
        return F.substring(text, F.lit(1), size)

    uuid = F.regexp_replace(F.substring("hex", 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    kinds = [cut(F.translate(base64, "+/=", "")), cut(base64), cut(F.translate(base64, "+/=", "-_")), cut(F.col("hex")), uuid]
    return rows.select(F.element_at(F.array(*kinds), (F.pmod("id", F.lit(len(kinds))) + 1).cast("int")).alias("token"))


def ordinary_strings(docs: DataFrame, max_docs: int) -> DataFrame:
    """token: the words of about ``max_docs`` documents at most, outside the base findings, and neighbours put together.

    A word and the next one make ``a_b``, ``a-b``, ``a/b``, ``aB`` and ``A_B``, as in names and paths.
    """
    share = min(1.0, max_docs / max(1, docs.count()))
    rows = documents_of(docs)
    if share < 1:
        rows = rows.filter(share_of(F.xxhash64("doc_id", "text"), share))
    rest = F.coalesce("text", F.lit(""))
    for kind in KINDS[:3]:
        rest = F.regexp_replace(rest, F.lit(_LONG[kind]), F.lit(" "))
    rows = rows.select(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)).alias("words"))
    nexts = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size(nexts)), nexts, lambda a, b: F.array(
        F.concat_ws("_", a, b), F.concat_ws("-", a, b), F.concat_ws("/", a, b), F.concat(a, F.initcap(b)),
        F.upper(F.concat_ws("_", a, b))))
    return rows.select(F.explode(F.concat("words", F.flatten(pairs))).alias("token"))


def labelled_samples(docs: DataFrame, max_docs: int = 1_000, n_random: int = 20_000) -> DataFrame:
    """(token, label): ``n_random`` random strings (1), and ordinary ones (0) from about ``max_docs`` of ``docs`` at most."""
    random = random_strings(docs.sparkSession, n_random).withColumn("label", F.lit(1))
    return random.unionByName(ordinary_strings(docs, max_docs).withColumn("label", F.lit(0)))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float] | None:
    """Log-likelihood ratio of every pair of characters, random against ordinary (None without samples of both)."""
    counts = samples.filter("token is not null and label is not null").groupBy("token", "label").count() \
        .select("label", "count", F.explode(_pairs(F.col("token"))).alias("pair")) \
        .groupBy("label", "pair").agg(F.sum("count").alias("n"))
    n = {0: [smoothing] * (SIZE * SIZE), 1: [smoothing] * (SIZE * SIZE)}
    seen = set()
    for r in counts.collect():  # at most two numbers per pair of characters
        label = int(r.label != 0)
        n[label][r.pair] += r.n
        seen.add(label)
    if len(seen) < 2:
        return None
    rows = {k: [sum(v[i * SIZE:(i + 1) * SIZE]) for i in range(SIZE)] for k, v in n.items()}
    return [math.log(n[1][i] / rows[1][i // SIZE]) - math.log(n[0][i] / rows[0][i // SIZE]) for i in range(SIZE * SIZE)]


def _ratio(token: Column, model: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.element_at(table, p + 1))


def _with_model(steps: Column, model: list[float] | None, min_ratio: float) -> Column:
    if model is None:
        return F.transform(steps, lambda s: F.struct(s["gap"], s["text"], F.lit(False).alias("keep")))
    return F.transform(steps, lambda s: F.struct(
        s["gap"], s["text"], (_ratio(s["text"], model) >= min_ratio).alias("keep")))


def _of_kind(found, kind: int) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"], F.lit(kind).alias("kind"), s["end"], s["text"]))


def scan(docs: DataFrame, model: list[float] | None, min_ratio: float = 12.0) -> DataFrame:
    """doc_id and findings: array<struct<start, kind, end, text>> by start, then kind (its place in ``KINDS``)."""
    rows = documents_of(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", *[_matches(F.col("text"), k).alias(k) for k in KINDS])
    rows = rows.withColumn("markov", _with_model(F.col("markov"), model, min_ratio))
    rows = rows.select("doc_id", *[F.when(F.col(k).isNotNull(), _located(F.col(k))).alias(k) for k in KINDS])
    rows = rows.select("doc_id", *[_shifted(F.col(k)).alias(k) for k in KINDS])
    base = F.concat(*[_of_kind(k, i) for i, k in enumerate(KINDS[:3])])
    rows = rows.select("doc_id", F.array_sort(base).alias("base"), "markov")
    # A span inside a base one adds nothing; one that goes beyond it does.
    apart = F.filter("markov", lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    findings = F.when(F.size("markov") > 0, F.array_sort(F.concat("base", _of_kind(apart, 3)))).otherwise(F.col("base"))
    return rows.select("doc_id", findings.alias("findings"))


def masked(docs: DataFrame, model: list[float] | None, min_ratio: float = 12.0) -> DataFrame:
    """``docs`` with every finding of ``text`` replaced by ``MASK``, pattern after pattern; null stays null.

    Where there is a column ``n_chars`` it is counted anew.
    """
    out, own, gaps = docs, free_name(docs.columns, "steps"), free_name(docs.columns, "gaps")
    for kind in KINDS:
        # One projection per pattern: the matches are found once.
        steps = _matches(F.col("text"), kind)
        if kind == "markov":
            steps = _with_model(steps, model, min_ratio)
        clean = F.when(F.col(own).isNull(), F.col("text")).otherwise(F.concat(
            F.array_join(F.zip_with(F.slice(F.col(gaps), 1, F.size(own)), F.col(own), lambda g, s: F.concat(
                g, F.when(s["keep"], F.lit(MASK)).otherwise(s["text"]))), ""), F.element_at(gaps, -1)))
        out = out.withColumns({own: steps, gaps: F.when(F.regexp_like("text", F.lit(_LONG[kind])),
                                                                   F.split("text", _LONG[kind], -1))}) \
            .withColumn("text", clean).drop(own, gaps)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op2``."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(findings):
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(
            ":", F.element_at(names, f["kind"] + 1), f["start"].cast("string"), f["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    base = F.filter("findings", lambda f: f["kind"] < 3)
    return result.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                         F.sha2(text(base), 256).alias("base_sha256"), text(F.col("findings")).alias("spans"))
