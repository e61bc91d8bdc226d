"""Work that has to spread or shrink with the input: sources of streams, ranges, indexes."""

import glob

import pytest
from pyspark.sql import functions as F

from helpers import SMALL

from tidemark import sinks
from tidemark.operators import search_index
from tidemark.plans import stream_queries
from tidemark.sinks import ranged_table
from tidemark.sources.tables import read_table


@pytest.fixture
def many_files(spark, tmp_path, monkeypatch):
    """Events in eight files; the scratch folder of the stream queries is ``run`` below it."""
    read_table(spark, SMALL, "events").repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream_queries, "scratch_path", lambda spark, name: f"{tmp_path}/run")
    return str(tmp_path)


@pytest.mark.parametrize("name,parts", [("dau_state_days", 4), ("dau_late_merge", 3), ("dau_stream_disorder", 4), ("dau_hourly_stream", 6)])
def test_a_part_of_the_log_is_written_by_several_tasks(spark, many_files, name, parts):
    assert stream_queries.QUERIES[name](spark, many_files).count() > 0
    assert len(glob.glob(f"{many_files}/run/source/*.parquet")) > parts


def test_rows_without_a_part_do_not_arrive(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("value"), F.when(F.col("id") >= 10, F.col("id") % 3).alias("part"))
    dealt = stream_queries._dealt(rows, str(tmp_path))
    for part in range(3):
        assert stream_queries._arrive(dealt, part, f"{tmp_path}/source").names == ["value"]
    assert spark.read.parquet(f"{tmp_path}/source").count() == 90


def test_micro_batches_of_changes_grow_with_the_cores(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "CDC_FILE_RECORDS", 100)
    stream_queries.run_cdc_stream(spark, SMALL)
    batches = [p for p in stream_queries.LAST_RUN["cdc_stream"][0].recentProgress if p.numInputRows]
    assert sum(p.numInputRows for p in batches) > 3200
    # All but the last one may take so many files.
    assert max(p.numInputRows for p in batches) > 8 * 100


def test_ranges_stay_bounded(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") * 7 % 3000).alias("a"))
    ranged_table.write(rows, f"{tmp_path}/t", 4, range_rows=200)
    counts = spark.read.parquet(f"{tmp_path}/t/counts").collect()
    assert len(counts) >= 12 and max(r.n for r in counts) < 400
    got = ranged_table.page_at(spark, f"{tmp_path}/t", rows.schema, 1990, 20).collect()
    assert [r.a for r in got] == list(range(1990, 2010))


def test_overwritten_partitions_keep_the_order_asked_for(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).select(F.xxhash64("id").alias("v"), (F.col("id") % 2).cast("string").alias("k"))
    sinks.overwrite_partitions(rows, f"{tmp_path}/t", "k", F.desc("v"))
    for file in glob.glob(f"{tmp_path}/t/k=*/*.parquet"):
        v = [r.v for r in spark.read.parquet(file).collect()]
        assert v == sorted(v, reverse=True)


def test_texts_are_taken_apart_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return text

    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.col("id").alias("n"),
                                   F.udf(count, "string")(F.concat(F.lit("word w"), F.col("id") % 9)).alias("text"))
    search_index.build(docs, f"{tmp_path}/ix", "text", "lang", "n", "doc_id", buckets=5, head=10)
    assert seen.value == 500
    assert [r.doc_id for r in search_index.find(spark, f"{tmp_path}/ix", "w3", "en", size=2).collect()] == [498, 489]
