"""Time expressions. Days and hours follow ``spark.sql.session.timeZone``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_ms(ms: Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd``."""
    return F.to_date(F.timestamp_millis(ms)).cast("string")


def hour_of_ms(ms: Column) -> Column:
    """Epoch milliseconds to a two-digit hour."""
    return F.date_format(F.timestamp_millis(ms), "HH")


def date_of_text(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to its date part."""
    return F.split_part(create_time, F.lit(" "), F.lit(1))


def hour_of_text(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to its two-digit hour part."""
    clock = F.split_part(create_time, F.lit(" "), F.lit(2))
    return F.split_part(clock, F.lit(":"), F.lit(1))


def timestamp_of_text(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a timestamp, null where it does not parse."""
    return F.try_to_timestamp(create_time, F.lit("yyyy-MM-dd HH:mm:ss"))


def as_date(value: Column | str | dt.date | None) -> Column:
    """A date column from a column, a literal date, or today's date for ``None``."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def age_years(birthday: Column, as_of: Column | str | dt.date | None = None) -> Column:
    """Whole calendar years from ``birthday`` (date or ``yyyy-MM-dd`` text) to ``as_of``.

    A birthday on 29 February is reached on 1 March of a common year, so ``months_between`` does not fit.
    """
    born = birthday.try_cast("date")
    today = as_date(as_of)
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    not_reached = F.when(month_day(today) < month_day(born), 1).otherwise(0)
    return (F.year(today) - F.year(born) - not_reached).cast("int")


def floor_ms(ms: Column, step_ms: int = 10_000) -> Column:
    """Epoch milliseconds rounded toward zero to a multiple of ``step_ms``."""
    return ms - ms % F.lit(step_ms)


def text_to_ms(text: Column) -> Column:
    """Text to bigint, null where it is not a number."""
    return text.try_cast("bigint")


def previous_day(day: str) -> str:
    """The day before ``yyyy-MM-dd``."""
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()
