"""Training corpus pipeline: five stages over ``documents``, each on what the one before kept.

1. quality: rows that the quality classifier scores under 0.5 go;
2. near_dedup: of each SimHash group one row stays, the one with the
   smallest doc_id (shingles of 3 words, at most 3 bits apart, as in the
   operator's contract);
3. decontaminate: rows that the contract calls contaminated go;
4. secrets: findings are masked in the text;
5. pack: the rest is packed into sequences of 2048 tokens.

Defined results: every stage judges rows, whatever their doc_id.  Rows that
repeat one, or have none, are told apart by a number of their own; of
equal doc_ids in a group the first row stays, and rows without one come
last.  A null text counts as empty: it is scored, is a group with the
other empty texts, is never contaminated and packs as its end id.  Repeated
rows are copies and one stays.  No rows give no rows.  Extra columns, also
such as have the operators' own names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, packing, quality_classifier, secret_scan, simhash
from tidemark.llm.common import scratch_path
from tidemark.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(spark, docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(spark, docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(spark, docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs, secret_scan.train(secret_scan.labelled_samples(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(spark, docs))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets),
          ("pack", pack)]

# Learned scores, XXH64 fingerprints and token ids are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; every stage's rows are written below the shared checkpoint folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
