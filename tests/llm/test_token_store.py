import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import encode, pfor, token_store
from tidemark.llm.common import scratch_path
from tidemark.sources.tables import read_table

TOK = Tokenizer.from_file(encode.default_path())


def expected(rows, end=2):
    ids = [(d, TOK.encode(t or "", add_special_tokens=False).ids + [end]) for d, t in rows]
    ids.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], np.uint16).tobytes()))
    out, at = [], 0
    for d, x in ids:
        out.append((d, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    return out


def run(spark, docs, **kw):
    path = scratch_path(spark, "tokens")
    files = token_store.write_tokens(docs, path, **kw)
    return sorted(map(tuple, token_store.digest(token_store.read_tokens(spark, path, files)).collect()),
                  key=lambda r: r[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50_000), st.integers(0, 2 ** 32 - 1)), max_size=700), st.floats(0.05, 1))
def test_blocks_round_trip(ids, percentile):
    body, index = pfor.pack_blocks(np.array(ids, np.uint32), percentile)
    assert pfor.unpack_blocks(np.frombuffer(body, np.uint8), index, len(ids)).tolist() == ids


ODD = ["don't can't X's,'s a'S", "é, «è» ×a÷b, Ünïx's!", "J̌K á, İİ", "<|startoftext|> a <|endoftext|>b",
       "x y\u0085z  q", "12a3,4.5-6", "日本語 テスト、ABC。", "a\x00b\x1fc,\x7f", "re%%% on***", "ſK K", "Σας ΣΑΣ,", "", " \n"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=30),
                          st.text("aAbB'sS,.éÉ×ß 1́̌J<|>", max_size=30)), min_size=1, max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    import pyarrow as pa

    ids, off = encode.encoder(encode.default_path()).rows(pa.array(texts))
    got = [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    assert got == [TOK.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 20_000])
def test_whole_table(spark, small, shard_bytes):
    docs = read_table(spark, small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert run(spark, docs, shard_bytes=shard_bytes) == expected(rows)


def test_odd_rows(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(50), t) for t in ODD] + [(None, "x"), (3, None), (3, "b"), (3, "a"), (7, "word " * 50_000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, ids int")
    assert run(spark, docs, shard_bytes=50) == expected(rows)


def test_no_rows(spark):
    assert run(spark, spark.createDataFrame([], "doc_id long, text string")) == []


def test_plain_words_are_encoded_without_the_pattern():
    from tidemark.llm.encode import Encoder, default_path

    enc = Encoder(default_path())
    seen = []
    usual = enc._encode
    enc._encode = lambda texts, tok=None: (seen.append((tok is enc.plain, " ".join(texts))), usual(texts, tok))[1]
    texts = ["Thonly eaenat it's THE don't xyz", "École élan naïve Ünder zzz", "a1b2 c", "日本 mixedÀ x", None, "", "qu'on " * 700, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(676))]
    ids, off = enc.rows(pa.array(texts))
    for t, a, b in zip(texts, off[:-1], off[1:]):
        assert ids[a:b].tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids
    plain = " ".join(t for is_plain, t in seen if is_plain).split()
    assert "thonly" in plain and "zzz" in plain and len(plain) > 676
    assert all(w.isascii() and w.isalpha() for w in plain)
