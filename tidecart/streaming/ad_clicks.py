"""Advertisement clicks as streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecart import schemas
from tidecart.functions import times
from tidecart.operators import routing
from tidecart.operators.arrival import arrived
from tidecart.plans import ad_clicks
from tidecart.sinks.ledger import CounterLedger, SetLedger
from tidecart.streaming.run import start

# Fixed value: batch interval of the click counters.
INTERVAL = "3 seconds"


def user_ad_ledger(spark: SparkSession, path: str) -> CounterLedger:
    return CounterLedger(spark, path, schemas.USER_AD_COUNT, ad_clicks.USER_AD, partition="dt")


def area_city_ledger(spark: SparkSession, path: str) -> CounterLedger:
    return CounterLedger(spark, path, schemas.AREA_CITY_AD_COUNT, ad_clicks.AREA_CITY_AD, partition="dt")


def black_list_ledger(spark: SparkSession, path: str) -> SetLedger:
    return SetLedger(spark, path, schemas.BLACK_LIST, ["userid"])


def handle_black_list(
    clicks: DataFrame,
    batch_id: int,
    counts: CounterLedger,
    black_list: SetLedger,
    threshold: int = ad_clicks.THRESHOLD,
) -> None:
    """Count the clicks of users not banned before this batch, store the counts and ban users over the threshold.

    Both tables are read as they were before the batch, so a replay decides the same.
    """
    batch = ad_clicks.user_ad_counts(clicks).persist()
    judged = None
    try:
        # Only entries of this batch's users and keys are looked at. The semi joins move below the reduction of the
        # ledgers, so what is shuffled grows with the batch and not with the tables.
        banned = black_list.read(before=batch_id).join(batch.select("userid"), "userid", "left_semi")
        days = batch.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")).first()
        keys = list(ad_clicks.USER_AD)
        totals = counts.read(before=batch_id, where=F.col("dt").between(days.lo, days.hi))
        totals = totals.join(batch.select(*keys), keys, "left_semi")
        judged = ad_clicks.judge(ad_clicks.accepted_counts(batch, banned), totals, threshold).persist()
        counts.write(ad_clicks.increments(judged), batch_id)
        black_list.write(ad_clicks.banned_users(judged), batch_id)
    finally:
        if judged is not None:
            judged.unpersist()
        batch.unpersist()


@contextmanager
def _letters_out(batch: DataFrame, batch_id: int, topics) -> Iterator[DataFrame]:
    """The clicks of a routed batch, held while they are used; its dead letters go to ``topics``."""
    batch.persist()
    try:
        if topics:
            topics.write(routing.dead_letters(batch, ad_clicks.DEAD_LETTER_TOPIC), batch_id)
        yield batch.where(F.col("route") == routing.STORED)
    finally:
        batch.unpersist()


def start_black_list(
    raw: DataFrame,
    counts: CounterLedger,
    black_list: SetLedger,
    threshold: int = ad_clicks.THRESHOLD,
    compact_every: int = 200,
    interval: str = INTERVAL,
    topics=None,
    **options,
) -> StreamingQuery:
    """``topics`` gets the lines that are no clicks; the accounts of each batch are metrics of the query."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _letters_out(batch, batch_id, topics) as clicks:
            handle_black_list(clicks, batch_id, counts, black_list, threshold)

    options["sinks"] = [topics] if topics else []
    return start(routing.watched(ad_clicks.routed(raw)), "ad_black_list", handle, interval=interval, tables=[counts, black_list], compact_every=compact_every, **options)


def start_area_city_counts(
    raw: DataFrame, counts: CounterLedger, compact_every: int = 200, interval: str = INTERVAL, topics=None, **options
) -> StreamingQuery:
    """``topics`` gets the lines that are no clicks; the accounts of each batch are metrics of the query."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _letters_out(batch, batch_id, topics) as clicks:
            counts.write(ad_clicks.area_city_counts(clicks), batch_id)

    options["sinks"] = [topics] if topics else []
    return start(routing.watched(ad_clicks.routed(raw)), "ad_area_city", handle, interval=interval, tables=[counts], compact_every=compact_every, **options)


def click_trend(
    clicks: DataFrame,
    lateness: str = "10 seconds",
    window_seconds: int = 60,
    slide_seconds: int = 10,
    clock: str | None = None,
) -> DataFrame:
    """Streaming form of the click trend, for append or update mode.

    Windows go by arrival (:func:`tidecart.operators.arrival.arrived`) and buckets by the clicks' own time, so every click
    counts in the windows in which it came in, and one dated in the future is a bucket of its own and closes nothing.
    """
    timed = ad_clicks.with_event_time(clicks).withColumn("arrived", arrived(clock)).withWatermark("arrived", lateness)
    bucket = times.floor_ms(F.unix_millis("event_time"), slide_seconds * 1000)
    return ad_clicks.trend_rows(
        timed.groupBy(F.window("arrived", f"{window_seconds} seconds", f"{slide_seconds} seconds"), bucket.alias("bucket_ms"))
    )


def start_click_trend(
    raw: DataFrame,
    sink_format: str = "console",
    checkpoint: str | None = None,
    name: str = "click_trend",
    mode: str = "update",
    lateness: str = "10 seconds",
    clock: str | None = None,
    interval: str = "10 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Show the trend of the last minute, by default on the console once per slide."""
    writer = click_trend(ad_clicks.parse(raw), lateness, clock=clock).writeStream.format(sink_format).queryName(name).outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": interval})).start()
