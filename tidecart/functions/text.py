"""Word search: a word is a maximal run of Unicode letters and digits, compared in lower case."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_BEFORE = r"(?<![\p{L}\p{N}])"
_EDGE_AFTER = r"(?![\p{L}\p{N}])"


def words(query: str) -> list[str]:
    """Distinct lower-case words of a query text, in their first order."""
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


def tokens(text: Column) -> Column:
    """Array of the lower-case words of a column."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def matches_all_words(text: Column, query: str) -> Column:
    """True where ``text`` holds every word of ``query``; a query without words matches nothing.

    A word can only match where it is a substring, so the cheap substring test runs first and the
    regular expression only sees the rows that pass it.
    """
    terms = words(query)
    if not terms:
        return F.lit(False)
    lowered = F.lower(text)
    tests = [F.contains(lowered, F.lit(t)) for t in terms]
    tests += [F.rlike(lowered, F.lit(f"{_EDGE_BEFORE}{t}{_EDGE_AFTER}")) for t in terms]
    return reduce(lambda a, b: a & b, tests)


def highlight(text: Column, query: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Put tags around every word of ``text`` that is a word of ``query``."""
    terms = words(query)
    if not terms:
        return text
    # Longest first, so that the alternation never stops at a shorter word.
    pattern = "|".join(sorted(terms, key=len, reverse=True))
    return F.regexp_replace(text, f"(?iu){_EDGE_BEFORE}({pattern}){_EDGE_AFTER}", f"{before}$1{after}")
