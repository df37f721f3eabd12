"""Advertisement clicks: counters, the click blacklist and the last-minute trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.functions import times
from tidecart.operators import routing
from tidecart.operators.counting import bucket_counts, count_by, sum_by, windows_over_buckets
from tidecart.operators.membership import not_listed
from tidecart.operators.parsing import evaluated_once

# Fixed value: clicks of one user on one advertisement in one day that are still accepted.
THRESHOLD = 30

# Ours: lines that are no clicks.
DEAD_LETTER_TOPIC = "AD_CLICK_DEAD_LETTER"

USER_AD = ("dt", "userid", "adid")
AREA_CITY_AD = ("dt", "area", "city", "adid")


def parse(raw: DataFrame) -> DataFrame:
    """Clicks from lines ``<epoch_ms> <area> <city> <user> <ad>``, with the arrival ``timestamp`` where the source has one; a line
    with missing fields is dropped."""
    kept = ["timestamp"] if "timestamp" in raw.columns else []
    parts = evaluated_once(raw, F.split(F.rtrim("value"), " "), "part", kept)
    fields = [F.get("part", F.lit(i)).alias(name) for i, name in enumerate(schemas.AD_CLICK.names)]
    return parts.where(F.size("part") >= len(fields)).select(*fields, *kept)


def routed(raw: DataFrame) -> DataFrame:
    """Every line with its click, ``route`` and ``reason``: dead are lines with missing fields or a time that is no number."""
    kept = ["value", *(["timestamp"] if "timestamp" in raw.columns else [])]
    parts = evaluated_once(raw, F.split(F.rtrim("value"), " "), "part", kept)
    fields = [F.get("part", F.lit(i)).alias(name) for i, name in enumerate(schemas.AD_CLICK.names)]
    lines = parts.select(*fields, *kept, F.coalesce(F.size("part") < len(fields), F.lit(True)).alias("__short"))
    dead = routing.reasons(missing_fields=F.col("__short"), time_is_no_number=times.text_to_ms(F.col("ts")).isNull())
    return routing.routed(lines, dead=dead).drop("__short")


def _with_day(clicks: DataFrame) -> DataFrame:
    """Clicks with their day; a click whose time is not a number is dropped."""
    ms = times.text_to_ms(F.col("ts"))
    return clicks.where(ms.isNotNull()).withColumn("dt", times.day_of_ms(ms))


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and advertisement."""
    named = _with_day(clicks).select("dt", F.col("user").alias("userid"), F.col("ad").alias("adid"))
    return count_by(named, USER_AD)


def area_city_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, area, city and advertisement."""
    named = _with_day(clicks).select("dt", "area", "city", F.col("ad").alias("adid"))
    return count_by(named, AREA_CITY_AD)


def accepted_counts(counts: DataFrame, black_list: DataFrame) -> DataFrame:
    """Counts of users who were not blacklisted before this batch.

    The blacklist holds users and counts are per user, so it is applied after counting: a hot user is then a few
    rows, not a third of all clicks.
    """
    return not_listed(counts, "userid", black_list, "userid")


def judge(counts: DataFrame, totals_before: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Batch counts with ``stored`` and ``banned`` flags.

    A batch count above the threshold bans the user and is not stored; any other count is stored, and bans the
    user when the running total passes the threshold.
    """
    before = totals_before.select(*USER_AD, F.col("count").alias("__before"))
    over = F.col("count") > threshold
    total = F.coalesce(F.col("__before"), F.lit(0)) + F.col("count")
    return counts.join(before, list(USER_AD), "left").select(
        *USER_AD, "count", (~over).alias("stored"), (over | (total > threshold)).alias("banned")
    )


def increments(judged: DataFrame) -> DataFrame:
    return judged.where("stored").select(*USER_AD, "count")


def banned_users(judged: DataFrame) -> DataFrame:
    return judged.where("banned").select("userid").distinct()


def click_buckets(clicks: DataFrame, bucket_seconds: int = 10) -> DataFrame:
    """Clicks per tumbling bucket of event time."""
    return bucket_counts(with_event_time(clicks), "event_time", bucket_seconds)


def click_trend(clicks: DataFrame, window_seconds: int = 60, slide_seconds: int = 10) -> DataFrame:
    """For every sliding window, the clicks of each bucket in it."""
    return windows_over_buckets(click_buckets(clicks, slide_seconds), window_seconds, slide_seconds)


def trend_rows(windowed: GroupedData) -> DataFrame:
    """``(window_start_ms, window_end_ms, bucket_ms, count)`` of clicks grouped by ``window`` and ``bucket_ms``."""
    counts = windowed.agg(F.count(F.lit(1)).alias("count"))
    start, end = (F.unix_millis(f"window.{edge}").alias(f"window_{edge}_ms") for edge in ("start", "end"))
    return counts.select(start, end, "bucket_ms", "count")


def with_event_time(clicks: DataFrame) -> DataFrame:
    ms = times.text_to_ms(F.col("ts"))
    return clicks.where(ms.isNotNull()).withColumn("event_time", F.timestamp_millis(ms))


def batch_counts(clicks: DataFrame, batch: Column) -> DataFrame:
    """Clicks per batch number, day, user and advertisement."""
    named = _with_day(clicks).select(batch.alias("batch"), "dt", F.col("user").alias("userid"), F.col("ad").alias("adid"))
    return count_by(named, ["batch", *USER_AD])


def replay_batches(per_batch: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Final ``(counts, black_list)`` of a whole history of batches, without running them one by one.

    Until a user is banned nothing of theirs is left out, so a key's first running total above the threshold is
    also the first batch in which it bans. The user is banned in the earliest such batch over their keys; counts of
    earlier batches are stored, and those of that batch where they alone are not above the threshold.
    """
    # A window holds one row per batch of one key.
    upto = Window.partitionBy(*USER_AD).orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    crossing = per_batch.withColumn("total", F.sum("count").over(upto)).where(F.col("total") > threshold)
    bans = crossing.groupBy("userid").agg(F.min("batch").alias("banned_in"))
    stored = (
        F.col("banned_in").isNull()
        | (F.col("batch") < F.col("banned_in"))
        | ((F.col("batch") == F.col("banned_in")) & (F.col("count") <= threshold))
    )
    return sum_by(per_batch.join(bans, "userid", "left").where(stored), USER_AD), bans.select("userid")
