"""Search operators against brute force on small inputs."""

import unicodedata

from pyspark.sql import functions as F

from helpers import SMALL
from tidemark.functions.schemas import MOVIE
from tidemark.operators import search
from tidemark.sources.tables import read_table


def _is_word(ch):
    return unicodedata.category(ch)[0] in "LN"


def _tokens_and_gaps(text):
    out, cur, cur_word = [], "", None
    for ch in text:
        w = _is_word(ch)
        if cur and w != cur_word:
            out.append((cur, cur_word))
            cur = ""
        cur += ch
        cur_word = w
    if cur:
        out.append((cur, cur_word))
    return out


def brute_highlight(text, toks):
    return "".join(f"<em>{p}</em>" if w and p.lower() in toks else p for p, w in _tokens_and_gaps(text))


def brute_match(text, toks):
    return any(w and p.lower() in toks for p, w in _tokens_and_gaps(text))


def test_query_tokens():
    assert search.query_tokens("License,  tion license") == ["license", "tion"]


def test_match_and_highlight_whole_texts(spark):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    q = "license tion the"
    toks = search.query_tokens(q)
    got = docs.select("doc_id", search.match(F.col("text"), q).alias("m"),
                      search.highlight(F.col("text"), q).alias("h")).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert r.m == brute_match(texts[r.doc_id], toks)
        assert r.h == brute_highlight(texts[r.doc_id], toks)


def test_match_is_whole_token(spark):
    df = spark.createDataFrame([("string ring",), ("strings",), ("RING.",), ("ringing",)], "t string")
    got = [r.m for r in df.select(search.match(F.col("t"), "ring").alias("m")).collect()]
    assert got == [True, False, True, False]


def test_find_nested_exists(spark):
    rows = [('{"id":"1","name":"a","doubanScore":6.5,"actorList":[{"id":"9","name":"x"},{"id":"8","name":"y"}]}',),
            ('{"id":"2","name":"b","doubanScore":7.5,"actorList":[{"id":"7","name":"z"}]}',)]
    df = spark.createDataFrame(rows, "j string").select(F.from_json("j", MOVIE).alias("m")).select("m.*")
    got = [r.id for r in search.find_nested(df, "actorList", "name", "y").collect()]
    assert got == ["1"]


def test_query_tokens_follow_the_text_rule():
    # An underscore and a combining mark (U+0301) separate tokens, as they do in the text;
    # a precomposed letter (U+00E9) does not.
    assert search.query_tokens("foo_bar e\u0301t\u00e9 42x") == ["foo", "bar", "e", "t\u00e9", "42x"]
