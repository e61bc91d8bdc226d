import random
import zlib

import brute
import numpy as np
from pyspark.sql import functions as F
from tidemark.llm import quality_classifier as C
from tidemark.llm import quality_rules as R
from tidemark.sources.tables import read_table

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, score int, rank int")


ODD = [(None, "a b"), (1, None), (2, ""), (3, "\n \n\t\n"), (4, "a\n\na\nb é\nb é\n b é"), (5, "x " * 60), (5, "x " * 60),
       (6, "é# *a$\n%&|<>" * 9), (7, " ".join(map(str, range(40))) + "\n" + " ".join(map(str, range(40)))), (8, "long word\n" * 60_000),
       (9, "\n"), (10, "q"), (11, "\x1fa\x00b c")]


def base_rows(spark, rows):
    got = R.judge(spark, frame(spark, rows), R.EMPTY).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    return sorted((tuple(r[c] for c in BASE) for r in got), key=str)


def test_base_matches_brute_force(spark, small):
    rnd = random.Random(9)
    rows = ODD + [(100 + i, "".join(rnd.choice("ab \n#é") for _ in range(rnd.randrange(300)))) for i in range(60)]
    assert base_rows(spark, rows) == sorted(brute.quality_base(rows), key=str)
    rows = [tuple(r) for r in read_table(spark, small, "documents").select("doc_id", "text").collect()]
    assert base_rows(spark, rows) == sorted(brute.quality_base(rows), key=str)
    assert base_rows(spark, []) == []


def test_trees_are_monotonic_and_learn():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * x[:, 1] + rnd.normal(0, 0.1, 4000)) > 0.6).astype(float)
    trees = R.boost(x, y, [1, 0, -1])
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.9
    for f, way in ((0, 1), (2, -1)):
        grid = np.repeat(x[:200], 50, axis=0)
        grid[:, f] = np.tile(np.linspace(0, 1, 50), 200)
        steps = np.diff(trees.scores(grid).reshape(200, 50), axis=1) * way
        assert steps.min() >= -1e-12
    free = R.boost(x, y, [0, 0, 0])
    grid = np.repeat(x[:200], 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 50), 200)
    assert np.diff(free.scores(grid).reshape(200, 50), axis=1).min() < 0  # what the constraint prevents


def test_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    got = R.judge(spark, docs, R.fit(docs, labels)).join(labels, "doc_id").filter(C.held_out()).filter("not base_failed")
    rows = got.collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    got = C.score(spark, docs, C.fit(spark, docs, labels))
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert got.count() == docs.count()


def test_training_ignores_held_out_labels(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    labels = read_table(spark, "/root/testdata/sf0.001", "labels")
    flipped = labels.withColumn("quality", C.F.when(C.held_out(), 1 - C.F.col("quality")).otherwise(C.F.col("quality")))
    a, b = C.fit(spark, docs, labels, bits=12), C.fit(spark, docs, flipped, bits=12)
    assert (a.weights == b.weights).all()


def test_scores_of_odd_rows(spark):
    docs = frame(spark, ODD)
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = C.fit(spark, docs, labels, bits=10)
    got = C.score(spark, docs, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = C.fit(spark, docs, labels.limit(0), bits=10)
    assert {r.score for r in C.score(spark, docs, none).collect()} == {0.5}
    assert C.score(spark, frame(spark, []), model).collect() == []
    assert R.fit(docs, labels.limit(0)) is R.EMPTY
    assert C.keep_good(spark, docs, none).count() == len(ODD)


def test_sample_is_bounded(spark):
    labels = spark.range(30_000).selectExpr("id doc_id", "1 quality")
    assert 800 < C.labelled_sample(labels, "quality", 1000).count() < 1200


def test_a_tiny_share_of_very_many_rows_still_draws_some(spark):
    from tidemark.llm.common import share_of

    rows = spark.range(2_000_000).select(F.xxhash64("id").alias("h"))
    assert 100 < rows.filter(share_of(F.col("h"), 1e-4)).count() < 300
    assert 0 < rows.filter(share_of(F.col("h"), 5e-6)).count() < 40
    assert rows.filter(share_of(F.col("h"), 1.0)).count() == 2_000_000
