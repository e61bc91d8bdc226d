import random

import brute
import numpy as np
import pyarrow as pa
from tidemark.llm import substring_dedup as S
from tidemark.llm.common import group_of, numbered
from tidemark.sources.tables import read_table


def _run(spark, rows, **kw):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, grp string, keys int")
    return sorted(map(tuple, S.digest(S.repeats_removed(docs, **kw)).drop("n_spans").collect()), key=str)


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for d in range(60):
        cut = rnd.randrange(350)
        t = base[cut:cut + rnd.randrange(5, 40)] + [rnd.choice("abc é") for _ in range(rnd.randrange(30))]
        rows.append((rnd.randrange(10 ** 6), rnd.choice([" ", "\n", " \t "]).join(t)))
    rows += [(None, rows[0][1]), (5, None), (6, ""), (7, "  \n"), (8, " ".join(base)), (8, " ".join(base)),
             (9, " ".join(["same"] * 40)), (10, " ".join(["same"] * 30)), (11, " ".join(base * 30))]
    # One byte per group: every document is its own group, so all matches cross groups.
    for group_bytes in (1 << 20, 200):
        assert _run(spark, rows, group_bytes=group_bytes) == sorted(brute.substring(rows), key=str)


def test_whole_table(spark, small):
    docs = read_table(spark, small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, S.digest(S.repeats_removed(docs, group_bytes=20_000)).drop("n_spans").collect()))
    assert got == sorted(brute.substring(rows))
    assert sum(r[2] for r in got) > 0


def test_spans_are_maximal(spark):
    a = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (2, f"x y {a} z")], "doc_id long, text string")
    row = S.repeats_removed(docs).filter("doc_id = 2").collect()[0]
    assert [tuple(s) for s in row.spans] == [(2, 30)]
    assert row.kept_text == "x y z"


def test_equal_first_hashes_are_told_apart():
    known, checks = np.array([1, 5, 5, 5, 9], np.uint64), np.array([0, 2, 4, 6, 1], np.uint64)
    asked = np.array([5, 5, 5, 1, 9, 7, 10], np.uint64), np.array([6, 2, 3, 0, 2, 1, 1], np.uint64)
    assert S._place(*asked, known, checks).tolist() == [3, 1, -1, 0, -1, -1, -1]
    none = np.zeros(0, np.uint64)
    assert S._place(*asked, none, none).tolist() == [-1] * 7 and S._place(none, none, known, checks).tolist() == []


def test_runs_inside_a_group_are_found_from_seeds():
    """Only runs around anchors that two documents hold are compared."""
    part = pa.table({"doc_id": [1, 2, 2, None], "text": [" ".join("abcdefghijklmnop"), "x " + " ".join("abcdefghijklmnop"),
                                                         " ".join("qrstuvwxyzABCDE"), " ".join("qrstuvwxyzABCDE")]})
    seeds = S._held_twice(*S._anchors(part, 13, 8))
    keys, checks, ids = S._near(part, 13, 8, seeds)
    assert len(seeds) and sorted(ids.tolist()).count(1) == 4 and len(keys) == len(checks) == len(ids) < 12
    assert len(S._first(keys, checks, ids)[0]) < len(keys)


def test_rows_without_id_and_repeated_ids_spread(spark):
    """A third of the rows without doc_id and a third with one and the same: no group holds them all."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, f"{i} {text}") for i in range(100)] + [(7, f"{text} {i}") for i in range(100)]
    rows += [(100 + i, text) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _run(spark, rows, group_bytes=1000) == sorted(brute.substring(rows), key=str)
    numbers, row = numbered(spark, docs)
    share = numbers.groupBy("doc_id", group_of(row, 20).alias("grp")).count().filter("doc_id is null or doc_id = 7")
    assert max(r["count"] for r in share.collect()) < 30


def test_no_rows(spark):
    assert _run(spark, []) == []
