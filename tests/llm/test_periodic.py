import hashlib
import random
import zlib

import brute
from tidemark.llm import periodic as P
from tidemark.sources.tables import read_table


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text, plant=True):
    words = brute.BLANK.findall(text or "")
    if plant:
        words = planted(doc_id, words)
    runs = brute.runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, brute.sha(lines),
            brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, [1], "x") for d, t in rows], "doc_id long, text string, runs array<int>, collapsed string")


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for d in range(150):
        a, words = rnd.randrange(1, 5), []
        while len(words) < rnd.randrange(5, 120):
            unit = [rnd.choice(["a", "bé", "c,", "日"][:a]) for _ in range(rnd.randrange(1, 7))]
            words += (unit * rnd.randrange(1, 9))[:rnd.randrange(1, 50)]
        rows.append((d, rnd.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(None, "x " * 9), (None, None), (900, None), (901, ""), (902, " \r\n\x0b"), (903, "z"), (903, "z"),
             (904, "same " * 4000), (905, "ab " * 5 + "c"), (906, "ab " * 6), (907, "a b " * 6), (903, "q r " * 300)]
    docs = _docs(spark, rows)
    assert _rows(P.digest(P.periodic_runs(docs))) == sorted((expected(*r, plant=False) for r in rows), key=str)
    # Slices of one row, and the contract's planted input.
    got = _rows(P.digest(P.periodic_runs(P.with_planted_tails(docs), slice_bytes=1)))
    assert got == sorted((expected(*r) for r in rows), key=str)


def test_other_limits(spark):
    rnd = random.Random(8)
    rows = [(d, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(60)))) for d in range(80)]
    for least, times in ((2, 2), (7, 3), (1, 5)):
        got = {r.doc_id: [tuple(x) for x in r.runs] for r in P.periodic_runs(_docs(spark, rows), least, times).collect()}
        assert got == {d: brute.runs(t.split(), least, times) for d, t in rows}


def test_whole_table(spark, small):
    docs = read_table(spark, small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = _rows(P.digest(P.periodic_runs(P.with_planted_tails(docs))))
    assert sum(r[1] for r in got) > len(rows) / 20
    short = {d for d, t in rows if len(t or "") < 6000}  # brute force is quadratic
    assert [r for r in got if r[0] in short] == sorted((expected(d, t) for d, t in rows if d in short), key=str)
    assert len(got) == len(rows)


def test_empty_table(spark):
    out = P.digest(P.periodic_runs(P.with_planted_tails(_docs(spark, []))))
    assert out.count() == 0 and hashlib.sha256(b"").hexdigest() == brute.sha("")


def test_very_long_text(spark):
    unit = [f"w{i}" for i in range(5000)]
    words = unit * 5 + ["x"] * 50_000
    (row,) = P.periodic_runs(_docs(spark, [(1, " ".join(words))])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 25_000, 5000), (25_000, 50_000, 1)]
    assert row.collapsed == " ".join([*unit, "x"])
