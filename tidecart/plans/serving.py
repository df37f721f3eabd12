"""Serving queries over the day tables.

Both day tables are partitioned by their date column, so a query reads one or two days of a few columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.functions import labels, times
from tidecart.functions.text import highlight, matches_all_words
from tidecart.operators.counting import count_by
from tidecart.operators.paging import SortKey, page, seek_page

# Columns of a detail row.
DETAIL_COLUMNS = (
    "create_time",
    "order_price",
    "province_name",
    "sku_name",
    "sku_num",
    "total_amount",
    "user_age",
    "user_gender",
)


#: Order of detail rows, and the rows up to which a page is taken from the sorted top.
DETAIL_ORDER = (SortKey("create_time", descending=True), SortKey("detail_id"))
_DEEP = 10_000


# --- active users ----------------------------------------------------------------------------


def dau_total(dau: DataFrame, day: str) -> DataFrame:
    """One row: active devices of ``day``, 0 for a missing day."""
    return dau.where(F.col("dt") == day).agg(F.count(F.lit(1)).alias("n"))


def dau_hourly(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``(dt, hr, n)`` of one day, or of all days; no rows for a missing day."""
    rows = dau if day is None else dau.where(F.col("dt") == day)
    return count_by(rows, ["dt", "hr"], "n")


def _two_days(dau: DataFrame, day: str) -> DataFrame:
    return dau.where(F.col("dt").isin(day, times.previous_day(day)))


def dau_realtime(dau: DataFrame, day: str) -> DataFrame:
    """``(metric, hr, n)``: ``dauTotal`` (one row, ``hr`` null), ``dauTd`` and ``dauYd`` (a row per active hour).

    The two days are read once: the total is the sum of the at most 24 hourly counts of ``day``.
    """
    hourly = dau_hourly(_two_days(dau, day))
    today = F.col("dt") == day
    hour = F.struct(F.when(today, "dauTd").otherwise("dauYd").alias("metric"), "hr", "n")
    one_row = hourly.agg(
        F.collect_list(hour).alias("hours"), F.coalesce(F.sum(F.when(today, F.col("n"))), F.lit(0)).alias("total")
    )
    total = F.struct(F.lit("dauTotal").alias("metric"), F.lit(None).cast("string").alias("hr"), F.col("total").alias("n"))
    return one_row.select(F.inline(F.concat(F.array(total), F.col("hours"))))


def dau_realtime_24h(dau: DataFrame, day: str) -> DataFrame:
    """``(hr, today, yesterday)`` for all 24 hours, 0 where nobody was active."""
    hours = dau.sparkSession.range(0, 24, 1, 1).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    today = F.col("dt") == day
    per_hour = (
        _two_days(dau, day).groupBy("hr").agg(F.count_if(today).alias("today"), F.count_if(~today).alias("yesterday"))
    )
    # At most 24 rows by construction.
    return hours.join(F.broadcast(per_hour), "hr", "left").select(
        "hr", F.coalesce("today", F.lit(0)).alias("today"), F.coalesce("yesterday", F.lit(0)).alias("yesterday")
    )


# --- sales of an item ------------------------------------------------------------------------


def _matching(wide: DataFrame, item_name: str, date: str | None) -> DataFrame:
    rows = wide if date is None else wide.where(F.col("create_date") == date)
    return rows.where(matches_all_words(F.col("sku_name"), item_name))


def _amount() -> Column:
    return F.sum("split_total_amount")


def stats_by_item(wide: DataFrame, item_name: str, date: str | None, by: str) -> DataFrame:
    """``(name, value)``: sales of the matching items by age band or by gender label.

    Rows without age or gender are left out. By age there are always three rows, or none when nothing
    matched. ``date=None`` gives the same per ``create_date``.
    """
    column = labels.group_column(by)
    keys = [] if date is not None else ["create_date"]
    known = _matching(wide, item_name, date).where(F.col(column).isNotNull())
    if by == "gender":
        named = known.withColumn("name", labels.gender_label(F.col(column)))
        return named.groupBy(*keys, "name").agg(_amount().alias("value"))
    band = labels.age_band(F.col(column))
    amount = F.coalesce(F.col("split_total_amount"), F.lit(0.0))
    sums = [F.sum(F.when(band == b, amount).otherwise(0.0)).alias(f"__{i}") for i, b in enumerate(labels.AGE_BANDS)]
    one_row = known.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 0)
    bands = [F.struct(F.lit(b).alias("name"), F.col(f"__{i}").alias("value")) for i, b in enumerate(labels.AGE_BANDS)]
    return one_row.select(*keys, F.inline(F.array(*bands)))


class ItemDetail(NamedTuple):
    total: DataFrame
    detail: DataFrame


def detail_by_item(wide: DataFrame, date: str, item_name: str, page_no: int = 1, page_size: int = 20) -> ItemDetail:
    """Exact number of matching lines, and one page of them, newest first, with the matched words marked. A page far down is
    sought by counting ranges; lines without a time or id, which have no place in that order, come on the first pages only."""
    found = _matching(wide, item_name, date)
    if page_no * page_size > _DEEP:
        rows = seek_page(found.where("create_time is not null and detail_id is not null"), DETAIL_ORDER, page_no, page_size)
    else:
        rows = page(found, [k.order() for k in DETAIL_ORDER], page_no, page_size)
    marked = rows.select(*[c for c in DETAIL_COLUMNS]).withColumn("sku_name", highlight(F.col("sku_name"), item_name))
    return ItemDetail(found.agg(F.count(F.lit(1)).alias("total")), marked)
