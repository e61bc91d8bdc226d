"""Search on a stored index: postings by term, in the order of the answer.

``build`` writes, for each token of each document, a posting with the
document's id, filter term and sort value: ``postings`` holds all, ``head``
the first ``head`` of every (token, filter term) in answer order.  Both are
in folders by a hash of the token and sorted by token inside, so a query
reads the folders of its tokens only and Parquet's statistics skip the
rest of a folder.  A page that ends within ``head`` needs the head alone:
a document among the first k of the answer is among the first k of each
of its tokens.  Deeper pages read the tokens' postings.

Tokens are those of ``search`` (letters and digits), folded to lower case.
The empty token stands for every document and answers the empty query.
A very frequent token is spread over many tasks: a folder's postings are
dealt to as many tasks as they fill, and the head's window is cut per task
first.  Neither deal samples its rows, so texts are taken apart once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .search import WORD, query_tokens

SCHEMA = "token string, term string, sort_value long, doc_id long, bucket int"


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _answer_order() -> list[Column]:
    return [F.desc_nulls_last("sort_value"), F.asc("doc_id")]


def build(docs: DataFrame, path: str, text_col: str, term_col: str, sort_col: str, id_col: str, buckets: int = 32, head: int = 100) -> None:
    """Write the index of ``docs`` below ``path``."""
    spark = docs.sparkSession
    tokens = F.coalesce(F.regexp_extract_all(F.lower(text_col), F.lit(f"([{WORD}]+)"), F.lit(1)), F.array().cast("array<string>"))
    rows = docs.select(F.col(term_col).cast("string").alias("term"), F.col(sort_col).cast("long").alias("sort_value"),
                       F.col(id_col).cast("long").alias("doc_id"), F.explode(F.array_distinct(F.array_append(tokens, F.lit("")))).alias("token"))
    rows = rows.select("token", "term", "sort_value", "doc_id", _bucket(F.col("token"), buckets).alias("bucket"))
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token", "term", *_answer_order())
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    spark.createDataFrame([(buckets, head)], "buckets int, head int").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    nth = F.row_number().over(Window.partitionBy("token", "term").orderBy(*_answer_order()))
    first = spark.read.schema(SCHEMA).parquet(f"{path}/postings").withColumn("nth", nth).where(F.col("nth") <= head).drop("nth")
    first.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token", "term", *_answer_order()) \
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/head")


def _postings(spark: SparkSession, path: str, part: str, tokens: list[str], buckets: int, term: str | None) -> DataFrame:
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/{part}")
    # Constant expressions: the optimizer turns them into numbers, which prune the folders.
    places = F.lit(False)
    for token in tokens:
        places = places | (F.col("bucket") == _bucket(F.lit(token), buckets))
    rows = rows.where(places & F.col("token").isin(tokens))
    return rows if term is None else rows.where(F.col("term") == term)


def find(spark: SparkSession, path: str, query: str, term: str | None = None, start: int = 0, size: int = 20) -> DataFrame:
    """``doc_id, term, sort_value`` of one page of the answer, as ``search.find`` orders it."""
    setting = spark.read.parquet(f"{path}/settings").first()
    tokens = query_tokens(query) or [""]
    # The head is cut per filter term, so without one it still holds the first ones of all.
    part = "head" if start + size <= setting.head else "postings"
    hits = _postings(spark, path, part, tokens, setting.buckets, term)
    # A document has a posting for each token: this many rows hold the page's documents.
    most = hits.orderBy(*_answer_order()).limit((start + size) * len(tokens)).drop("token", "bucket").distinct()
    page = most.orderBy(*_answer_order())
    return (page.offset(start) if start else page).limit(size).select("doc_id", "term", "sort_value")


def total(spark: SparkSession, path: str, query: str, term: str | None = None) -> DataFrame:
    """Number of documents that match, from the postings of the query's tokens."""
    setting = spark.read.parquet(f"{path}/settings").first()
    hits = _postings(spark, path, "postings", query_tokens(query) or [""], setting.buckets, term)
    return hits.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("total"))
