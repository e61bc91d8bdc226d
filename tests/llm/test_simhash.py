import random

import brute
import numpy as np
import pytest
from tidemark.llm import simhash as S
from tidemark.llm.components import components
from tidemark.sources.tables import read_table


def _run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, fp int, place int")
    return sorted(map(tuple, S.digest(S.near_duplicates(spark, docs)).collect()), key=str)


def test_matches_brute_force(spark):
    rnd = random.Random(2)
    base = [[f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(60, 200))] for _ in range(6)]
    rows = []
    for d in range(150):
        t = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            t[rnd.randrange(len(t))] = rnd.choice(["x", "Y", "é"])
        rows.append((rnd.randrange(1000), rnd.choice([" ", "\n", "\t "]).join(t)))
    rows += [(None, rows[0][1]), (5, None), (6, ""), (7, " \x0b"), (8, "one"), (9, "ONE two"), (9, "ONE two"), (None, "z z z z"),
             (11, "long text " * 40_000)]
    got = _run(spark, rows)
    assert got == sorted(brute.simhash(rows), key=str)
    assert len({r[2] for r in got}) < len({r[1] for r in got})  # different fingerprints are linked


def test_whole_table(spark, small):
    rows = [tuple(r) for r in read_table(spark, small, "documents").select("doc_id", "text").collect()]
    assert _run(spark, rows) == sorted(brute.simhash(rows), key=str)


@pytest.mark.parametrize("pairwise", [8192, 64])
def test_dense_places_lose_no_link(pairwise):
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 2 ** 63, 5)
    fp = np.unique(np.concatenate([b ^ np.bitwise_or.reduce(
        np.uint64(1) << rnd.integers(40, 52, (300, 5)).astype(np.uint64), axis=1).astype(np.int64) for b in base]))
    zero = np.zeros(len(fp), np.int64)
    a, b = S.linked(zero, zero, fp, 3, pairwise)
    got = S._Sets(len(fp))
    got.join(np.searchsorted(fp, a), np.searchsorted(fp, b))
    want = S._Sets(len(fp))
    want.join(*np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3))
    assert (got.of == want.of).all()


def test_blocks_cover_close_pairs():
    rnd = random.Random(1)
    masks = S.block_masks(3)
    for _ in range(300):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), 3):
            y ^= 1 << b
        assert any((x ^ y) & (m % 2 ** 64) == 0 for m in masks)


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(spark, df).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}


def test_one_of_each_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (1, "A b c d"), (2, "q r s t"), (None, "a b c d")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in S.one_of_each(spark, docs).collect()) == ["1", "2"]  # the row without doc_id is a copy
    assert _run(spark, []) == []
