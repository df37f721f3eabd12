"""Counters and time buckets. All combine on the map side, so hot keys do not reach the shuffle as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Totals of per-batch increments."""
    return df.groupBy(*keys).agg(F.sum(name).alias(name))


def bucket_counts(df: DataFrame, time_column: str, bucket_seconds: int = 10) -> DataFrame:
    """Rows per tumbling bucket as ``(bucket_ms, count)``. Works on streams with a watermark."""
    return (
        df.groupBy(F.window(time_column, f"{bucket_seconds} seconds"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.unix_millis("window.start").alias("bucket_ms"), "count")
    )


def windows_over_buckets(counts: DataFrame, window_seconds: int = 60, slide_seconds: int = 10) -> DataFrame:
    """Every sliding window that covers a bucket: ``(window_start_ms, window_end_ms, bucket_ms, count)``.

    A bucket is one slide wide, so each window repeats whole bucket counts: the rows are multiplied after the
    count, not before it, and no second shuffle is needed.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    window_ms, slide_ms = window_seconds * 1000, slide_seconds * 1000
    back = F.sequence(*(F.lit(v).cast("bigint") for v in (0, window_ms - slide_ms, slide_ms)))
    start = F.col("bucket_ms") - F.col("back")
    return counts.select("bucket_ms", "count", F.explode(back).alias("back")).select(
        start.alias("window_start_ms"), (start + window_ms).alias("window_end_ms"), "bucket_ms", "count"
    )
