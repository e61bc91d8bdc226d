import random

import brute
import pyarrow as pa
import pytest
from tidemark.llm import decontam as D
from tidemark.sources.tables import read_table

DOCS, ITEMS = "doc_id long, text string, seg int, row int", "item_id long, text string, spans string"


def _run(spark, rows, items, **kw):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], DOCS)
    bench = spark.createDataFrame([(d, t, "") for d, t in items], ITEMS)
    return sorted(map(tuple, D.digest(D.contamination(spark, docs, bench, **kw)).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"segment_bytes": 300, "block_words": 30}])
def test_matches_brute_force(spark, kw):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["Été", "É1", "x"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(100, None), (101, " ,; "), (None, "w1"), (3, "w2 w3 w4"), (103, "zz " * 20)]
    rows = [(d, rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocab).upper() for _ in range(rnd.randrange(60))) + " "
             + rnd.choice(items)[1].__str__()) for d in range(60)]
    rows += [(None, items[2][1]), (7, None), (8, ""), (9, "zz " * 400), (9, "zz " * 400), (10, items[5][1] * 50)]
    assert _run(spark, rows, items, **kw) == sorted(brute.decontam(rows, items), key=str)


def test_empty_tables(spark):
    assert _run(spark, [], [(1, "a b")]) == []
    assert _run(spark, [(1, "a b")], []) == [(1, 2, 0, 0, brute.sha(""), False)]


def test_whole_table(spark, small):
    rows = [tuple(r) for r in read_table(spark, small, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read_table(spark, small, "benchmark").collect()]
    got = _run(spark, rows, items, segment_bytes=50_000)
    assert got == sorted(brute.decontam(rows, items), key=str)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_blocks_hold_every_window_once(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate([1, 3, 12, 13, 14, 40, 0, 25])] + [(None, "a b"), (99, None)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    for block_words in (20, 1000):
        got = []
        for path in D.write_blocks(spark, bench, 13, block_words):
            h, windows = D._block(path)
            for size, first, item in windows:
                got += [(int(i), tuple(h[a:a + size].tolist())) for a, i in zip(first, item)]
        want = []
        for i, t in items:
            w = D.words(pa.array([t or ""]))[0].tolist() if i is not None else []
            k = min(13, len(w))
            want += [(i, tuple(w[a:a + k])) for a in range(len(w) - k + 1) if k]
        assert sorted(got) == sorted(want)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b c"), (2, "a x x x x x b c"), (3, "c b a"), (4, "a b"), (5, "a | b | c")],
                                 "doc_id long, text string")
    index = D.build_index(spark, docs)
    assert sorted({r.doc_id for r in D.proximity_hits(index, [(9, "a b c")], 2).collect()}) == [1, 3, 5]
