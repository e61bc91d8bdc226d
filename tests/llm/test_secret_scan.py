import hashlib
import random
import re
import string
import uuid

import brute
import pytest
from tidemark.llm import secret_scan as S
from tidemark.sources.tables import read_table

BASE = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "q", 1) for d, t in rows], "doc_id long, text string, markov string, base int")


@pytest.fixture(scope="module")
def model(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    return S.train(S.labelled_samples(docs))


def base(spark, rows, model=None):
    return sorted((tuple(r[c] for c in BASE) for r in S.digest(S.scan(frame(spark, rows), model)).collect()), key=str)


ODD = [(None, "password=abcdef"), (1, None), (2, ""), (3, "tokEN = token:abcdefgh"), (4, "token=token:abcdefgh token=abc secret: 'abcdef'"),
       (5, "é\U0001f600 API_KEY:\"a.b/c+d=\" apikey=x"), (5, "é\U0001f600 API_KEY:\"a.b/c+d=\" apikey=x"), (6, "ſecret=abcdefg toKen=abcdefg"),
       (7, "AKIA" * 9 + " AKIA" + "B" * 15 + " AKIA" + "B" * 16 + "AKIAX"), (8, "0" * 23 + "g" + "a1" * 12 + "G" + "f" * 30),
       (9, "passwd=" + "0123456789abcdef" * 3), (10, "token=abcdefg\n" * 1500), (11, "password  =  =abcde password==abcdef"),
       (12, "x" * 200_000 + " secret=hidden1"), (13, "token=\nabcdefgh"), (14, "\x00token=abcdef\x00")]


def test_base_matches_brute_force(spark):
    rnd = random.Random(4)
    parts = ["token", "=", " ", "'", '"', ":", "abc", "abcdef", "AKIA", "0123456789abcdef", "é", "Secret", "\n", "api_key", "="]
    rows = ODD + [(100 + i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(60)))) for i in range(150)]
    assert base(spark, rows) == sorted(brute.secrets(rows), key=str)
    rows = [tuple(r) for r in read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    got = base(spark, rows)
    assert got == sorted(brute.secrets(rows), key=str) and sum(r[1] for r in got)
    assert base(spark, []) == []


def test_model_adds_random_strings_only(spark, model):
    rnd = random.Random(8)
    alike = ["".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(20)]
    words = ["internationalisation", "thereforethinninghereto", "averylongidentifiername", "ononerhereandthere_ofthe"]
    rows = [(i, f"see {t} here") for i, t in enumerate(alike)] + [(100 + i, f"see {t} here") for i, t in enumerate(words)]
    got = {r.doc_id: [(f.kind, f.start, f.text) for f in r.findings] for r in S.scan(frame(spark, rows), model).collect()}
    assert all(got[i] == [(3, 4, t)] for i, t in enumerate(alike))
    assert all(got[100 + i] == [] for i in range(len(words)))


def test_added_spans_leave_base_ones(spark, model):
    text = "token=" + hashlib.sha256(b"x").hexdigest() + " and Zx9Qw7Lk2Vb8Nm4Tr6Yp1Hg3Jd5Fs0 end"
    row = S.digest(S.scan(frame(spark, [(1, text)]), model)).collect()[0]
    assert row.spans == "assign:0:70,hex:6:70,markov:75:105" and row.n_assign == row.n_hex == 1
    assert row.base_sha256 == brute.sha("assign:0:70,hex:6:70")


def test_masked_keeps_the_rest(spark, model):
    docs = spark.createDataFrame([(1, "a token=abcdefgh b token=abc é " + "f" * 30, 9), (2, None, 4), (3, "clean\ntext", 10)],
                                 "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, S.masked(docs, model).collect()))
    want = "a [SECRET] b token=abc é [SECRET]"
    assert got == [(1, want, len(want)), (2, None, 4), (3, "clean\ntext", 10)]


def test_no_python_on_the_main_path(spark, model):
    plan = S.scan(frame(spark, ODD), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_training_needs_both_labels(spark):
    assert S.train(spark.createDataFrame([("abc", 0), (None, 1), ("x", None)], "token string, label int")) is None


def test_spans_beyond_a_base_span_are_kept(spark, model):
    """A random string of which a pattern covers the end only."""
    text = "see Zx9Qw7Lk2Vb8Nm4Tr6Yp1Hg3Jd5Fs0" + "0123456789abcdef01234567" + " here"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = S.digest(S.scan(one, model)).first().spans.split(",")
    assert "hex:33:58" in spans or "hex:34:58" in spans
    assert any(s.startswith("markov:4:") for s in spans)


def planted(rnd):
    """A random string that no pattern finds: base62, base64, its URL form, or a UUID."""
    kind = rnd.randrange(4)
    if kind == 3:
        return str(uuid.UUID(int=rnd.getrandbits(128)))
    letters = string.ascii_letters + string.digits + ("", "+/", "-_")[kind]
    return "".join(rnd.choice(letters) for _ in range(rnd.randrange(24, 60)))


def test_model_spans_match_brute_force(spark, model):
    rnd = random.Random(11)
    parts = ["token=", " ", "'", "abc", "Zx9Qw7Lk2Vb8", "AKIA", "0123456789abcdef", "é", "\n", "_of_the_", "-", "/", "\U0001f600", "."]
    rows = ODD + [(100 + i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))) for i in range(200)]
    rows += [(400 + i, f"é {planted(rnd)} {planted(rnd)}.") for i in range(40)]
    want = sorted((str(d), brute.secret_spans(t or "", model)) for d, t in rows)
    got = S.digest(S.scan(frame(spark, rows), model)).select("doc_id", "spans").collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == want
    assert sum("markov" in s for _, s in want) > 60


def test_random_strings_outside_the_patterns_are_found_and_masked(spark, model):
    rnd = random.Random(12)
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").limit(400).collect()
    secrets = {d.doc_id: planted(rnd) for d in docs}
    rows = [(d.doc_id, f"{d.text or ''} {secrets[d.doc_id]} end") for d in docs]
    found = {r.doc_id: {f.text for f in r.findings if f.kind == 3} for r in S.scan(frame(spark, rows), model).collect()}
    hit = [d for d, t in secrets.items() if t in found[d]]
    assert len(hit) >= 0.98 * len(secrets)
    clean = {r.doc_id: r.text for r in S.masked(frame(spark, rows), model).collect()}
    assert all(secrets[d] not in clean[d] for d in hit)
    # What the scan adds besides the planted strings: next to nothing.
    assert sum(len(found[d] - {t}) for d, t in secrets.items()) <= 2


def test_identifiers_are_ordinary(spark, model):
    """Names that the training never saw, of words of the texts."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("text").limit(300).collect()
    words = sorted({w for d in docs for w in re.findall("[a-z]{4,}", d.text or "")})
    rnd = random.Random(13)
    names = []
    for _ in range(500):
        w = [rnd.choice(words) for _ in range(3)]
        names.append(rnd.choice(["_".join(w), "-".join(w), "/".join(w), w[0] + w[1].title() + w[2].title(), "_".join(w).upper()]))
    got = S.scan(frame(spark, [(i, n) for i, n in enumerate(names)]), model).collect()
    assert sum(bool(r.findings) for r in got) <= 5


def test_samples_are_bounded_and_repeat(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    two = [sorted(map(tuple, S.random_strings(spark, 50).collect())) for _ in range(2)]
    assert two[0] == two[1] and len(two[0]) == 50 and all(20 <= len(t) <= 64 for t, in two[0])
    none = S.labelled_samples(docs.limit(0), n_random=5)
    assert none.count() == 5 and S.train(none) is None
    few = S.ordinary_strings(docs, 50).count()
    assert 0 < few < S.ordinary_strings(docs, 10 ** 9).count() / 4


def test_masked_agrees_with_scan(spark, model):
    """A row changes exactly where the scan finds something."""
    rows = [(i, t) for i, (_, t) in enumerate(ODD)] + [(50, "nothing to see here"), (51, "id Zx9Qw7Lk2Vb8Nm4Tr6Yp1Hg3Jd5Fs0 x")]
    found = {r.doc_id for r in S.scan(frame(spark, rows), model).filter("size(findings) > 0").collect()}
    texts = dict(rows)
    changed = {r.doc_id for r in S.masked(frame(spark, rows), model).collect() if r.text != texts[r.doc_id]}
    assert found == changed and 51 in found and 50 not in found
