import zlib
from collections import defaultdict

import brute
import numpy as np
import corpus_pipeline as P
from pyspark.sql import functions as F
from tidemark.llm import decontam, quality_classifier, quality_rules, secret_scan, simhash
from tidemark.sources.tables import read_table
from tokenizers import Tokenizer
from tidemark.llm.encode import default_path

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns, frame = docs.columns, docs
    seen = {}
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
        seen[name] = frame = frame.cache()
    rows = {n: {r.doc_id: r.text for r in f.collect()} for n, f in seen.items()}
    source = {r.doc_id: r.text for r in docs.collect()}

    scores = quality_classifier.score(spark, docs, quality_classifier.fit(spark, docs, read_table(spark, SF, "labels")))
    assert set(rows["quality"]) == {r.doc_id for r in scores.collect() if r.predicted}
    want = {d for d, _, c in brute.simhash(list(rows["quality"].items())) if d == c}
    assert set(rows["near_dedup"]) == want
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").collect()]
    hit = {r[0] for r in brute.decontam(list(rows["near_dedup"].items()), items) if r[5]}
    assert hit and set(rows["decontaminate"]) == want - hit
    assert all(rows["decontaminate"][d] == source[d] for d in rows["decontaminate"])
    # Masked where there is a finding, else untouched.
    found = {r[0] for r in brute.secrets(list(rows["decontaminate"].items())) if sum(r[1:4])}
    assert found and all(("[SECRET]" in t) == (d in found) or t != source[d] for d, t in rows["secrets"].items())
    assert all(t == source[d] for d, t in rows["secrets"].items() if "[SECRET]" not in t)
    assert not any(sum(r[1:4]) for r in brute.secrets(list(rows["secrets"].items())))

    tok, texts = Tokenizer.from_file(default_path()), defaultdict(int)
    for r in P.STAGES[-1][1](spark, frame, SF).collect():
        ids = tok.encode(rows["secrets"][r.doc_id], add_special_tokens=False).ids + [1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        texts[r.doc_id] += r.length
        assert r.doc_tokens == len(ids)
    assert set(texts) == set(rows["secrets"])


def test_no_rows_and_nulls(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, 0), (2, "", "en", "s", 0)], docs.schema)
    for start in (odd, docs.limit(0)):
        frame = start
        for _, stage in P.STAGES:
            frame = stage(spark, frame, "/root/testdata/sf0.001")
            frame.collect()


def test_rows_not_ids_are_judged(spark):
    words = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, words), (5, words), (5, other), (None, other), (None, "solo text of its own"), (None, "solo text of its own"), (7, None), (None, None)]
    frame = spark.createDataFrame([(d, t, i, 0, "a") for i, (d, t) in enumerate(rows)],
                                  "doc_id long, text string, row_number int, stays int, component_id string")
    kept = simhash.one_of_each(spark, frame)
    assert kept.columns == frame.columns
    assert sorted(r.row_number for r in kept.collect()) in ([0, 2, 4, 6], [0, 2, 5, 6])
    bench = spark.createDataFrame([(1, other)], "item_id long, text string")
    rows = [(1, words), (1, other), (None, other), (None, words), (2, None)]
    frame = spark.createDataFrame([(d, t, i, 0) for i, (d, t) in enumerate(rows)], "doc_id long, text string, goes int, n_hit int")
    kept = decontam.clean(spark, frame, bench)
    assert kept.columns == frame.columns and sorted(r.goes for r in kept.collect()) == [0, 3, 4]


def test_clashing_columns_in_every_stage(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    names = ["steps", "gaps", "__steps", "row_number", "fp", "seg", "rank", "score", "label", "grp", "terms", "one"]
    frame = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, "/root/testdata/sf0.001")
        assert frame.columns == [*docs.columns, *names], name
    assert {tuple(r) for r in frame.select(*names).distinct().collect()} == {tuple(range(len(names)))}
    assert P.STAGES[-1][1](spark, frame, "/root/testdata/sf0.001").count() > 0


def test_the_training_bound_holds_for_repeated_ids(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    assert np.isfinite(quality_classifier.fit(spark, docs, labels, max_train_rows=10).weights).all()
    assert quality_rules.fit(docs, labels, max_train_rows=10) is not None


def test_run(spark):
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "pack"]
    assert secret_scan.KINDS[-1] == "markov"
