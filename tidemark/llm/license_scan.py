"""License scan with DataFrame functions only: TF-IDF cosine to templates, then inheritance by folder.

1. Segments: every line of a text that speaks of a licence, and the
   whole text of a licence file (by its name), for the one-line
   statements; for the standard headers and licence texts, which run
   over many lines, the leading comment block, every paragraph that
   speaks of a licence, all from the first such paragraph to the last,
   and again a licence file as a whole.  Equal segments are folded
   first, so a header that a third of all files carry is one row.
2. Term frequencies of segments and templates become sparse TF-IDF rows
   (document frequencies over the segments of all files, for
   statements and for texts apart); a join on the
   term gives the cosine to every template, and the best one over a
   threshold is the segment's licence.
3. A file's own licence is its best segment's.  A file without one takes
   that of the nearest folder above it that holds a licence file:
   folders are folded, their ancestors joined with the licensed folders,
   and the deepest wins.

Defined results: a null text has no segment; a null path has no folder
and inherits nothing; of equal cosines the smallest name wins; rows that
repeat a file_id are one file and each gets its result; a row without
file_id can only inherit; no rows give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .licence_texts import HEADERS, TEXTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRIGGER = r"(?i)licen[sc]|copyright|copyleft|creative commons|public domain|spdx"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-][^/]*)?$"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
# Lines of a comment, blank ones too; lines without a letter or digit part paragraphs, also within a comment.
COMMENT = r"^\s*(?:$|#|//|--|;|%|\*|'|\.\.|(?:REM|rem|dnl) )"
PARAGRAPH = r"\n[^\p{L}\p{N}]*\n"
THRESHOLD = 0.6
# Short statements by which files name their licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the Mozilla Public License, version 2.0."),
]


def folder_of(path: Column) -> Column:
    """Folder of a path; empty for a file at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def is_licence_file(path: Column) -> Column:
    return F.coalesce(F.regexp_like(F.regexp_extract(path, r"([^/]*)$", 1), F.lit(LICENCE_FILE)), F.lit(False))


def _speaks(text: Column) -> Column:
    return F.regexp_like(text, F.lit(TRIGGER))


def _lead(text: Column) -> Column:
    """The comment block at the start, after a ``#!`` or ``<?`` line."""
    text = F.regexp_replace(text, r"^(?:#!|<\?)[^\n]*\n", "")
    lines = F.split(text, "\n", -1)
    code = F.array_position(F.transform(lines, lambda line: F.regexp_like(line, F.lit(COMMENT))), False)
    marked = F.array_join(F.slice(lines, 1, F.when(code > 0, code - 1).otherwise(F.size(lines)).cast("int")), "\n")
    return F.when(F.regexp_like(text, F.lit(r"^\s*/\*")), F.substring_index(text, "*/", 1)) \
        .when(F.regexp_like(text, F.lit(r"^\s*<!--")), F.substring_index(text, "-->", 1)) \
        .when(F.regexp_like(text, F.lit(r'^\s*"""')), F.substring_index(text, '"""', 2)).otherwise(marked)


def _notice(text: Column) -> Column:
    """From the first paragraph that speaks of a licence to the last."""
    parts = F.split(text, PARAGRAPH, -1)
    speaks = F.transform(parts, _speaks)
    first, after = F.array_position(speaks, True), F.array_position(F.reverse(speaks), True)
    return F.array_join(F.slice(parts, first.cast("int"), (F.size(parts) - after - first + 2).cast("int")), "\n\n")


def segments(files: DataFrame) -> DataFrame:
    """file_id, long, segment and its key (a digest): licence lines and files, and (long) blocks and files."""
    text, none = F.col("text"), F.array().cast("array<string>")
    whole = F.coalesce(F.when(is_licence_file(F.col("path")) & text.isNotNull(), F.array(text)), none)
    lines = F.coalesce(F.when(_speaks(text), F.filter(F.split(text, "\n", -1), _speaks)), none)
    # A paragraph without any word of a licence may still stand between two that have one.
    blocks = F.coalesce(F.when(_speaks(text), F.filter(F.concat(
        F.split(text, PARAGRAPH, -1), F.array(_lead(text), _notice(text))), _speaks)), none)
    both = F.concat(F.transform(F.concat(lines, whole), lambda x: F.struct(F.lit(False).alias("long"), x.alias("segment"))),
                    F.transform(F.array_distinct(F.concat(blocks, whole)), lambda x: F.struct(F.lit(True).alias("long"), x.alias("segment"))))
    return files.select("file_id", F.inline(both)).withColumn("key", F.sha2("segment", 256))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def segment_licences(spark: SparkSession, found: DataFrame, templates: list[tuple[str, str]],
                     threshold: float) -> DataFrame:
    """key, best: struct(least: minus the cosine, licence) of every segment near a template."""
    # From here on a segment is its digest: no row repeats a long text per term.
    folded = found.groupBy("key").agg(F.first("segment").alias("segment"), F.count(F.lit(1)).alias("n"))
    rows = folded.select("key", "n", _terms(F.col("segment")).alias("terms")).select("key", "n", F.explode("terms").alias("term")) \
        .groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("n").alias("n"))
    df = rows.groupBy("term").agg(F.sum("n").alias("df"))
    n_all = found.count()

    def weighed(frame):
        idf = F.log((1 + F.lit(n_all)) / (1 + F.coalesce("df", F.lit(0)))) + 1
        return frame.join(df, "term", "left").withColumn("w", (1 + F.log("tf")) * idf)

    near = weighed(rows)
    norm = near.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    frame = spark.createDataFrame(templates, "licence string, text string")
    known = weighed(frame.select("licence", F.explode(_terms(F.col("text"))).alias("term"))
                    .groupBy("licence", "term").agg(F.count(F.lit(1)).alias("tf")))
    known_norm = known.groupBy("licence").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("known_norm"))
    dots = near.join(known.select("licence", "term", F.col("w").alias("v")), "term") \
        .groupBy("key", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("known_norm")), 6)
    return dots.join(norm, "key").join(known_norm, "licence").withColumn("cosine", cosine) \
        .filter(F.col("cosine") >= threshold) \
        .groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("least"), "licence")).alias("best"))


def licences(spark: SparkSession, files: DataFrame, templates: list[tuple[str, str]] | None = None,
             threshold: float = THRESHOLD, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """file_id, path, licence, cosine, via ('header' or 'folder'), folder of every file (file_id, path, text).

    ``templates`` is a short list of (licence, statement), one each; ``texts`` a bounded one of (licence, header or text).
    """
    rows = files.select(files["file_id"], files["path"].cast("string").alias("path"), files["text"].cast("string").alias("text"))
    found = stored(spark, segments(rows), "licence-lines")  # the texts are read once
    named = segment_licences(spark, found.filter("not long"), templates or TEMPLATES, threshold).withColumn("long", F.lit(False))
    # A licence has several texts: each is a template of its own.
    texts = [(f"{name}\t{i}", text) for i, (name, text) in enumerate(HEADERS + TEXTS if texts is None else texts)]
    if texts:
        near = segment_licences(spark, found.filter("long"), texts, threshold)
        licence = F.substring_index("best.licence", "\t", 1).alias("licence")
        named = named.unionByName(near.select("key", F.struct("best.least", licence).alias("best"), F.lit(True).alias("long")))
    named = stored(spark, named, "licence-names")  # small, and used by several branches
    own = found.filter("file_id is not null").select("file_id", "long", "key").join(named, ["key", "long"]).groupBy("file_id").agg(F.min("best").alias("own"))
    places = rows.select("file_id", "path").join(own, "file_id", "left").withColumn("folder", folder_of(F.col("path")))
    licensed = places.filter(is_licence_file(F.col("path")) & F.col("own").isNotNull()) \
        .groupBy("folder").agg(F.min("own").alias("given")).withColumnRenamed("folder", "above")
    parts = F.split("folder", "/", -1)
    depth = F.when(F.col("folder") == "", 0).otherwise(F.size(parts))
    ancestors = F.transform(F.sequence(F.lit(0), depth), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("above")))
    nearest = places.filter("own is null and folder is not null").select("folder").distinct() \
        .select("folder", F.explode(ancestors).alias("a")).select("folder", "a.depth", "a.above") \
        .join(licensed, "above").groupBy("folder").agg(F.max_by(F.struct("above", "given"), "depth").alias("from"))
    # Written, so that the join below deals both sides and can split a folder that holds many files.
    nearest = stored(spark, nearest, "licensed-folders")
    out = places.join(nearest, "folder", "left")
    best = F.coalesce("own", "from.given")
    return out.select("file_id", "path", best["licence"].alias("licence"), (-best["least"]).alias("cosine"),
                      F.when(F.col("own").isNotNull(), "header").when(F.col("from").isNotNull(), "folder").alias("via"),
                      F.when(F.col("own").isNull(), F.col("from.above")).alias("folder"))


def documents_as_files(docs: DataFrame) -> DataFrame:
    """``documents`` has no paths: source/lang/doc_id, and a text that opens with a licence line as its folder's licence file."""
    opens = F.regexp_like(F.regexp_extract("text", r"^[^\n]*", 0), F.lit(TRIGGER))
    name = F.when(opens, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat("doc_id", F.lit(".txt")))
    return docs.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", "source", "lang", name).alias("path"), "text")
