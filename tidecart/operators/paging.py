"""Top groups and result pages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_groups(counts: DataFrame, n: str, key: str, k: int) -> DataFrame:
    """The ``k`` groups with the largest ``n``; ties by key."""
    return counts.orderBy(F.desc(n), F.asc(key)).limit(k)


class SortKey(NamedTuple):
    """A sort column without nulls."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)


def _from(keys: Sequence[SortKey], values: Sequence, strictly: bool = False) -> Column:
    """Rows at or after the row with ``values`` in the order of ``keys``; with ``strictly`` only those after it."""
    result = F.lit(not strictly)
    for key, value in reversed(list(zip(keys, values))):
        column, bound = F.col(key.name), F.lit(value)
        result = (column < bound if key.descending else column > bound) | ((column == bound) & result)
    return result


def page_after(df: DataFrame, keys: Sequence[SortKey], last: Sequence | None, page_size: int = 20) -> DataFrame:
    """The page that follows the row with the sort values ``last``, or the first one. Each task keeps one page, however deep."""
    rows = df if last is None else df.where(_from(keys, last, strictly=True))
    return rows.orderBy(*[k.order() for k in keys]).limit(page_size)


def seek_page(df: DataFrame, keys: Sequence[SortKey], page_no: int, page_size: int = 20, most: int = 10_000, ranges: int = 32) -> DataFrame:
    """The same page as :func:`page` without sorting all rows before it.

    The order is cut into ranges at the sort values of some rows, the rows of each range are counted, and only the ranges that
    hold the page are looked into further, until they have at most ``most`` rows (or no two rows differ). Together ``keys``
    must name a row; the cuts only steer, so the page is exact whatever they are. A pass reads the key columns and its result
    is one count per range.
    """
    if page_no < 1 or page_size < 1:
        raise ValueError("page_no and page_size start at 1")
    skip, names = (page_no - 1) * page_size, [k.name for k in keys]
    rows, left = df, None
    while left is None or left > max(most, 2 * page_size):
        # A bounded sample in hash order, the same on every run; each range holds several of its rows.
        by_hash = rows.select(*names).orderBy(F.xxhash64(*names, F.lit(left or 0))).limit(8 * ranges)
        sample = [tuple(r) for r in by_hash.orderBy(*[k.order() for k in keys]).collect()]
        cuts = list(dict.fromkeys(sample[len(sample) // ranges :: max(1, len(sample) // ranges)]))
        if not cuts:
            break
        number = sum((F.when(_from(keys, cut), 1).otherwise(0) for cut in cuts), F.lit(0))
        counted = {r["n"]: r["count"] for r in rows.select(number.alias("n")).groupBy("n").count().collect()}
        before, first, last, held = 0, None, None, 0
        for n in range(len(cuts) + 1):
            size = counted.get(n, 0)
            if before < skip + page_size and before + size > skip:
                first = n if first is None else first
                last, held = n, held + size
            elif first is None:
                before += size
                continue
            before += size
        if first is None:
            return rows.where(F.lit(False))
        skip -= sum(counted.get(n, 0) for n in range(first))
        if first:
            rows = rows.where(_from(keys, cuts[first - 1]))
        if last < len(cuts):
            rows = rows.where(~_from(keys, cuts[last]))
        if held == left:
            break
        left = held
    return rows.orderBy(*[k.order() for k in keys]).offset(skip).limit(page_size)


def page(df: DataFrame, order: Sequence[Column], page_no: int = 1, page_size: int = 20) -> DataFrame:
    """One of the first pages in ``order``: Spark keeps the first ``page_no * page_size`` rows per task. Deep ones are for
    :func:`seek_page`."""
    if page_no < 1 or page_size < 1:
        raise ValueError("page_no and page_size start at 1")
    return df.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)
