import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models

from tidemark.llm import bpe
from tidemark.sources.tables import read_table

ODD = [None, "", "  \n", "a", "aaaa" * 50, "ΣΑΣ Σ", "İstanbul ǅ", "é x", "<|endoftext|> hi<|startoftext|><|ENDOFTEXT|>",
       "don't we'LL", "1234 a1b2", "日本語テキスト。", "👍🏽 ok", "\x00\x1f a b c", "!!!??? ...", "a" * 5000 + " " + "ab" * 4000]


def _docs(spark, texts):
    return spark.createDataFrame([(None if i == 3 else i // 2, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")


def _expected(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_equals_the_library(spark, name):
    path, rnd = public_tokenizers.path(name), random.Random(2)
    texts = ODD + ["".join(rnd.choice("abcdeeeinthsrao 's'DLL12 .,!é ñß日Ω\n\t") for _ in range(rnd.randrange(300))) for _ in range(200)]
    tok = Tokenizer.from_file(path)
    got = bpe.digest(bpe.decode(bpe.encode(_docs(spark, texts), path), path)).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(_expected(tok, t) for t in texts)
    assert [r.doc_id for r in got].count(None) == 1


def test_whole_table(spark, small):
    docs = read_table(spark, small, "documents")
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: _expected(tok, r.text) for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digest(bpe.decode(bpe.encode(docs))).collect()}
    assert got == want


def _words(rnd, n):
    return ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(n)]


def test_merges_in_any_order():
    """Rules in an order no training gives, so that a merge wakes earlier rules, also amid its own places."""
    rnd, woken = random.Random(4), 0
    for _ in range(60):
        tokens, pairs = ["a", "b", "c"], []
        for _ in range(40):
            a, b = rnd.choice(tokens), rnd.choice(tokens)
            if (a, b) not in pairs and len(a + b) < 9:
                pairs.append((a, b))
                if a + b not in tokens:
                    tokens.append(a + b)
        rnd.shuffle(pairs)
        vocab = {t: i for i, t in enumerate(tokens)}
        own, words = bpe.Merges(vocab, pairs, ""), _words(rnd, 60)
        woken += int(own.once.sum())
        ids, size = own.merged(words)
        tok = Tokenizer(models.BPE(vocab=vocab, merges=pairs))
        want = [tok.encode(w).ids for w in words]
        assert ids.tolist() == [i for w in want for i in w] and size.tolist() == [len(w) for w in want]
    assert woken > 100


def test_unknown_symbols_and_ids():
    vocab = {"a": 0, "b": 1, "ab": 2}
    ids, size = bpe.Merges(vocab, [("a", "b")], "").merged(["axb", "x", "", "ab"])
    assert ids.tolist() == [2, 2] and size.tolist() == [1, 0, 0, 1]
    codec = bpe.codec(public_tokenizers.path("word_bpe_49k.json"))
    some = codec.texts(pa.array([b"\x05\0\0\0\xff\xff\xff\x7f\x06\0\0\0", None, b""], pa.binary())).to_pylist()
    assert some == [codec.tok.decode([5, 6], skip_special_tokens=False), "", ""]


def test_empty_table(spark):
    assert bpe.digest(bpe.decode(bpe.encode(_docs(spark, [])))).count() == 0


def test_plain_words_are_merged_here():
    """Words of a-z skip normalizer and pattern in the shared encoder; this one still merges them itself."""
    codec = bpe.PairIndexCodec(public_tokenizers.path("word_bpe_49k.json"))
    seen, merged = [], codec.merges.merged
    codec.merges.merged = lambda words: (seen.extend(words), merged(words))[1]
    texts = ["Plain zyx words", None, "it's Élan a1 <|endoftext|> qqqzzz", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(676))]
    ids, off = codec.rows(pa.array(texts))
    for t, a, b in zip(texts, off[:-1], off[1:]):
        assert ids[a:b].tolist() == codec.tok.encode(t or "", add_special_tokens=False).ids
    assert {"plain", "zyx", "words", "waa", "wzz", "qqqzzz"} <= set(seen)
