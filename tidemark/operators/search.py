"""Document search: full-text token match, term filter, sort, page, highlight.

A document matches when any query token occurs in its text as a whole
token (letters and digits, case-insensitive), like a ``match`` query with
OR semantics.  The sort is explicit, so no relevance score is computed;
top-k is ``orderBy(...).limit(k)`` which Spark runs as a per-task top-k
and one small merge (TakeOrderedAndProject), never a full sort.

The array filter (``exists(actors, a -> a.name = x)``) is offered in two
forms: on documents that already carry the array (``find_nested``), and on
flat turn rows (``find_grouped``), where it is a per-group ``bool_or``
aggregate, so no group is ever collected into one array.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A token is a maximal run of letters and digits.
WORD = r"\p{L}\p{N}"
# The highlight tags around a matched token.
HIGHLIGHT_PRE, HIGHLIGHT_POST = "<em>", "</em>"


def query_tokens(query: str) -> list[str]:
    """Lower-cased distinct tokens of a query string, in order.

    A token is a maximal run of letters and digits (Unicode categories L*
    and N*), the same rule ``match`` and ``highlight`` apply to the text.
    """
    seen: list[str] = []
    cur = ""
    for ch in query.lower() + " ":
        if unicodedata.category(ch)[0] in "LN":
            cur += ch
            continue
        if cur and cur not in seen:
            seen.append(cur)
        cur = ""
    return seen


def _alternation(tokens: Sequence[str]) -> str:
    return "|".join(r"\Q" + t + r"\E" for t in tokens)


def token_pattern(tokens: Sequence[str]) -> str:
    """Java regex finding any of ``tokens`` as a whole token, ignoring case."""
    return rf"(?iu)(?<![{WORD}])(?:{_alternation(tokens)})(?![{WORD}])"


def match(text: Column, query: str) -> Column:
    """True when any query token occurs in ``text`` as a whole token."""
    toks = query_tokens(query)
    if not toks:
        return F.lit(True)
    return text.rlike(token_pattern(toks))


def highlight(text: Column, query: str) -> Column:
    """``text`` with every matched token wrapped in ``<em>…</em>`` (whole text)."""
    toks = query_tokens(query)
    if not toks:
        return text
    pattern = rf"(?iu)(?<![{WORD}])({_alternation(toks)})(?![{WORD}])"
    return F.regexp_replace(text, pattern, HIGHLIGHT_PRE + "$1" + HIGHLIGHT_POST)


def find(docs: DataFrame, text_col: str, query: str, term_col: str | None = None,
         term: str | None = None, sort_col: str | None = None, tie_col: str | None = None,
         start: int = 0, size: int = 20, with_highlight: bool = False) -> DataFrame:
    """``must match(text) + filter term`` sorted by ``sort_col`` desc, one page."""
    # The cheap term test comes first: conjuncts short-circuit in order, so
    # the whole-text regex only runs on documents that pass the term filter.
    hits = docs
    if term_col is not None and term is not None:
        hits = hits.where(F.col(term_col) == F.lit(term))
    hits = hits.where(match(F.col(text_col), query))
    order = [F.desc_nulls_last(sort_col)] if sort_col else []
    if tie_col:
        order.append(F.asc(tie_col))
    page = hits.orderBy(*order) if order else hits
    page = page.offset(start).limit(size) if start else page.limit(size)
    if with_highlight:
        page = page.withColumn("highlight", highlight(F.col(text_col), query))
    return page


def find_nested(docs: DataFrame, array_col: str, field: str, value: str) -> DataFrame:
    """Documents whose array of objects has an element with ``field == value``."""
    return docs.where(F.exists(array_col, lambda a: a[field] == F.lit(value)))


def find_grouped(rows: DataFrame, group_col: str, order_col: str, text_col: str,
                 member_col: str, member: str, query: str, size: int = 20) -> DataFrame:
    """Search over groups of flat rows (e.g. turns of a conversation).

    Per group: ``name`` = text of the first row by ``order_col``; the group
    passes when some row has ``member_col == member`` and ``name`` matches
    ``query``.  Sorted by row count desc, then group id; one page.
    """
    per_group = rows.groupBy(group_col).agg(
        F.min_by(text_col, order_col).alias("name"),
        F.bool_or(F.col(member_col) == F.lit(member)).alias("_has"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    hits = per_group.where(F.col("_has") & match(F.col("name"), query))
    return hits.orderBy(F.desc("n_rows"), F.asc(group_col)).limit(size) \
               .select(group_col, "n_rows")
