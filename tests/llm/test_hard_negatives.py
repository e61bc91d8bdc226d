import math
import random

import pytest

from tidemark.llm import hard_negatives as H
from tidemark.sources.tables import read_table

NAN, INF = float("nan"), float("inf")


def brute(rows, positives=5, negatives=3):
    """The contract's rule over (vec_id, vector, label) rows; equal scores of one id go by the row's place."""
    own = []
    for at, (v, x, label) in enumerate(rows):
        if v is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        own.append((v, at, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * c) for c in x]))
    out = []
    for v, at, label, x in own:
        if v % 50:
            continue
        near = sorted((-sum(a * b for a, b in zip(x, y)), w, place, other) for w, place, other, y in own if place != at)
        for s, p, _, _ in [r for r in near if r[3] == label][:positives]:
            some = [(-t, n) for t, n, _, other in near if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(v, p, i + 1, n, -s, t) for i, (t, n) in enumerate(some[:negatives])]
    return sorted(out)


def _table(spark, rows):
    return spark.createDataFrame([(v, x, n, 1, "a") for v, x, n in rows],
                                 "vec_id long, embedding array<float>, label int, row int, anchor string").coalesce(1)


def _mined(spark, table, **kw):
    return sorted(map(tuple, H.mine(spark, H.contract_rows(table), **kw).collect()))


def _f(x):
    import struct
    return struct.unpack("f", struct.pack("f", x))[0]


def test_matches_brute_force(spark):
    rnd = random.Random(6)
    common = [0.5, 0.25, -0.125, 1.0]
    rows = [(rnd.randrange(600), common if rnd.random() < .3 else [_f(rnd.gauss(0.3, 0.4)) for _ in range(4)], rnd.randrange(4)) for _ in range(500)]
    rows += [(50, None, 1), (100, [NAN, 1.0, 0.0, 0.0], 1), (150, [1.0, None, 0.0, 0.0], 2), (200, [INF, 0.0, 0.0, 0.0], 0), (None, common, 1),
             (250, common, None), (300, [], 2), (350, [0.5], 3), (400, [0.0] * 4, 8), (450, [0.0] * 4, 8), (451, [0.0] * 4, 7)]
    want = brute(rows)
    assert len(want) > 50
    table = _table(spark, rows)
    assert _mined(spark, table) == want
    assert _mined(spark, table, row_groups=3, anchor_block=4, file_rows=37, chunk=16) == want


def test_exact_beyond_doubles(spark):
    rows = [(50, [3e6, 1.0], 1), (1, [3e6, 1.0], 1), (2, [2e6, 0.00390625], 2), (3, [2e6, 0.0078125], 2), (4, [2e6, 0.0], 2), (5, [2e6, 0.015625], 2)]
    assert _mined(spark, _table(spark, rows)) == brute(rows)
    with pytest.raises(Exception, match="too large"):
        _mined(spark, _table(spark, [(50, [3e30], 1), (1, [3e30], 1)]))


def test_few_rows(spark):
    assert _mined(spark, _table(spark, [])) == []
    assert _mined(spark, _table(spark, [(50, [1.0], 1)])) == []
    assert _mined(spark, _table(spark, [(50, [1.0], 1), (51, [1.0], 2)])) == []


def test_windows_hold_one_anchor():
    keys = sorted(bytes(k.as_py()) for args in (([5, 5, 9], [1, 1, 2], [100, 10, 80], 0, [7, 8, 9]),
                                               ([5, 5, 5, 9], [1, 1, 1, 2], [96, 95, 9, 41], 1, [3, 4, 5, 6]))
                  for k in H._packed(*(H.np.array(a) if isinstance(a, list) else a for a in args),
                                     H.np.zeros(len(args[0]), int)).column(0))
    assert list(H.windows(iter(keys), 3, 50, 95)) == [(1, 7, 1, 4, 100, 95), (1, 8, 1, 5, 10, 9), (2, 9, 1, 6, 80, 41)]


def test_whole_table(spark, small):
    table = read_table(spark, small, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert _mined(spark, table) == brute(rows)
