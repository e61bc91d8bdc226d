"""Registered search and nested-document queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonfn
from ..functions.schemas import MOVIE
from ..operators import search, search_index
from ..session import scratch_path
from ..sources.tables import read_table

# Fixed query parameters of the test fixtures.
DOC_QUERY, DOC_LANG = "license tion", "en"
CONV_QUERY, CONV_ROLE = "the", "assistant"
ACTOR_NAME = "de"
PAGE_SIZE = 20


def q_search_find(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return search.find(docs, "text", DOC_QUERY, "lang", DOC_LANG, "n_chars", "doc_id",
                       size=PAGE_SIZE).select("doc_id", "lang", "n_chars")


def q_search_indexed(spark, sf_dir):
    """The answer of ``search_find`` from a stored index."""
    path = scratch_path(spark, "search_index")
    search_index.build(read_table(spark, sf_dir, "documents"), path, "text", "lang", "n_chars", "doc_id")
    page = search_index.find(spark, path, DOC_QUERY, DOC_LANG, size=PAGE_SIZE)
    return page.select("doc_id", F.col("term").alias("lang"), F.col("sort_value").alias("n_chars"))


def q_search_highlight(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return search.find(docs, "text", DOC_QUERY, "lang", DOC_LANG, "n_chars", "doc_id",
                       size=PAGE_SIZE, with_highlight=True).select("doc_id", "highlight")


def q_search_grouped(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return search.find_grouped(conv, "conv_id", "turn", "text", "role", CONV_ROLE, CONV_QUERY,
                               size=PAGE_SIZE)


def movie_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents (object + array of objects) rendered as JSON text."""
    d = read_table(spark, sf_dir, "documents")
    movie = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.concat_ws(":", "lang", "source").alias("name"),
        (F.col("n_chars").cast("double") / 1000).alias("doubanScore"),
        F.struct(F.col("source").alias("id"), F.col("lang").alias("name")).alias("directors"),
        F.array(
            F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("name")),
            F.struct(F.col("source").alias("id"), F.col("n_chars").cast("string").alias("name")),
        ).alias("actorList"),
    )
    return d.select(jsonfn.to_text(movie).alias("json"))


def parsed_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_docs(spark, sf_dir).select(jsonfn.parse_typed(F.col("json"), MOVIE).alias("m")) \
                                    .select("m.*")


def q_nested_json_roundtrip(spark, sf_dir):
    m = parsed_movies(spark, sf_dir)
    return m.select(
        "id", "name", "doubanScore",
        F.col("directors.name").alias("director_name"),
        jsonfn.element(F.col("actorList"), 1)["name"].alias("second_actor"),
        F.size("actorList").alias("n_actors"),
    )


def q_nested_search(spark, sf_dir):
    m = search.find_nested(parsed_movies(spark, sf_dir), "actorList", "name", ACTOR_NAME)
    return m.orderBy(F.desc("doubanScore"), F.asc("id")).limit(PAGE_SIZE).select("id", "doubanScore")


QUERIES = {
    "search_find": q_search_find,
    "search_indexed": q_search_indexed,
    "search_highlight": q_search_highlight,
    "search_grouped": q_search_grouped,
    "nested_json_roundtrip": q_nested_json_roundtrip,
    "nested_search": q_nested_search,
}
