import re

from tidemark.llm import queries
from tidemark.llm import url_filter as U
from tidemark.sources.tables import read_table

RULES = queries.URL_RULES


def judged(spark, rows, **kw):
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, host string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(spark, pages, RULES, **kw).collect()}


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_rules(spark):
    urls = ["http://A.EXAMPLE.com/en/1", "https://www.example.com/en/x?y=/z", "http://example.com", "http://example.com?/en/",
            "ftp://x.net/es/#f", "http://net/fr/", "http://inet/fr/", "no scheme com/", None, "", "://com/", "http://ÉX.com/\n/a",
            "http://x.org/?u=http://example.com/en/", "a://b://c/d", "http://example.com:80/en/", "http://xexample.com/en/"]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_aliases(spark):
    def link(x):
        return f"<p><LINK rel='canonical' HREF=\"{x}\">"
    rows = [
        (1, "http://a.org/1", link("http://example.com/en/7")),  # to a blocked address that is no page
        (2, "http://b.org/x/y", link("../2")), (3, "https://b.org/x/../2#top", None),
        (4, "http://c.org/", '<meta http-equiv="refresh" content="0; url=//d.net/fr/1">'),
        (5, "http://c.org/#part", None), (6, "https://c.org", ""),  # the same address as page 4
        (7, "http://e.org/1", link("http://a.org/1")),  # through page 1
        (8, "http://f.com/z", link("http://a.org/1")),  # own allow stays, and names the resource
        (9, "http://g.org/1", link("http://h.net/es/2")), (10, "http://h.net/es/2", None), (10, "http://h.net/es/2", None),
        (11, "http://g.org/1?a=1", link("")), (12, None, link("http://h.net/es/2")),
    ]
    got = {k: v[3] for k, v in judged(spark, rows).items()}
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow",
                   9: "block", 10: "block", 11: "allow", 12: "allow"}
    more = spark.createDataFrame([("http://i.org/", "http://j.org/"), ("http://j.org/", "http://h.net/es/2")], "from_url string, to_url string")
    assert judged(spark, [(1, "http://i.org/", None)], more_edges=more)[1][3] == "block"


def test_whole_table_and_no_rows(spark, small):
    pages = read_table(spark, small, "pages")
    got = [tuple(r) for r in U.digest(U.judge(spark, pages, RULES)).collect()]
    assert sorted(got) == sorted((r.page_id, *brute(r.url)) for r in pages.collect())
    assert judged(spark, []) == {}
