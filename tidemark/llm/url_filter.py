"""URL filter with redirect equivalence.

Rules ``(verdict, "host/path")`` fit their host and its subdomains when
the url's path starts with the rule's path; the longest wins.  A page
names its aliases itself: canonical links and refresh redirects in its
HTML, or further (from, to) pairs.  Connected components over these
edges join the addresses of one resource, and a block reaches the
members without a rule of their own.  Explicit allows come first: an
own allow is never overruled, and a resource that an allow names is not
blocked through another of its addresses.

An address is host, path and query; scheme and fragment do not matter.
Targets that are no page take part too.

Defined results: a null url or one without ``://`` has empty host and
path, no rule and no aliases (allowed); null html has no links; every
row is judged, also repeated ones; no rows give no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components

ALLOW, BLOCK = "allow", "block"
MOST_RULES = 1000  # the rules are literals of the plan
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query of a url; null if it has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(url.contains("://"), F.concat(host_of(url), rest))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The longest is tested first; of equal rules an allow.
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == ALLOW)):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        chain = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chain)
    return chain


def _absolute(target: Column, url: Column) -> Column:
    """``target`` of a link on the page ``url``, as an absolute url (null if empty)."""
    scheme, host = F.regexp_extract(url, r"(?s)^(.*?)://", 1), host_of(url)
    site = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    t = F.trim(F.regexp_replace(target, "&amp;", "&"))
    return (F.when(t == "", F.lit(None))
            .when(F.regexp_like(t, F.lit(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://")), t)
            .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
            .when(t.startswith("/"), F.concat(site, t))
            .when(t.startswith("?"), F.concat(site, path_of(url), t))
            .when(t.startswith("#"), F.lit(None))
            .otherwise(F.concat(site, folder, t)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): addresses that a page's canonical links and refresh redirects declare the same."""
    value = r"(?is)\b{}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))"

    def attribute(tag, name):
        return F.concat(*[F.regexp_extract(tag, value.format(name), i) for i in (1, 2, 3)])

    links = F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(0)), lambda t: attribute(t, "href"))
    moves = F.transform(F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(0)), lambda t: F.regexp_extract(
        attribute(t, "content"), r"(?is)^\s*[\d.]+\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"']*)", 1))
    found = pages.filter(F.col("url").contains("://")).select("url", F.explode(F.concat(links, moves)).alias("target"))
    return found.select(address_of(F.col("url")).alias("a"),
                        address_of(_absolute(F.col("target"), F.col("url"))).alias("b"))


def judge(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]],
          more_edges: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict of every page.

    ``more_edges`` (from_url, to_url): redirects known from elsewhere, as crawl logs.
    """
    rows = pages.select(pages["page_id"], pages["url"].cast("string").alias("url"),
                        pages["html"].cast("string").alias("html"))
    edges = alias_edges(rows)
    if more_edges is not None:
        edges = edges.unionByName(more_edges.select(address_of(F.col("from_url")).alias("a"),
                                                    address_of(F.col("to_url")).alias("b")))
    same = components(spark, edges)
    as_url = F.concat(F.lit("//://"), F.col("node"))
    ruled = same.withColumn("own", rule_of(host_of(as_url), path_of(as_url), rules)["verdict"])
    blocked = ruled.groupBy("root").agg(F.max(F.col("own") == BLOCK).alias("b"), F.max(F.col("own") == ALLOW).alias("a")) \
        .filter("b and not coalesce(a, false)").select("root")
    reached = same.join(blocked, "root").select(F.col("node").alias("address"), F.lit(True).alias("reached"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = rows.select("page_id", "url", host.alias("host"), path.alias("path"),
                         address_of(F.col("url")).alias("address"), rule_of(host, path, rules).alias("own"))
    return judged.join(reached, "address", "left").select(
        "page_id", "url", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", F.when(F.col("reached"), BLOCK), F.lit(ALLOW)).alias("verdict"))


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op9``."""
    return result.select("page_id", "host", "path", "rule", "verdict")
