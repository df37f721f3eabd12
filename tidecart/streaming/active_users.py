"""Daily active users as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecart import schemas
from tidecart.operators.arrival import arrived
from tidecart.operators.audit import with_row_count
from tidecart.operators.membership import not_stored
from tidecart.plans import active_users
from tidecart.sinks.ledger import FirstLedger
from tidecart.streaming.change_capture import dims_for
from tidecart.streaming.run import start


def dau_ledger(spark: SparkSession, path: str) -> FirstLedger:
    """Day records by day and device; the first one stored stays."""
    return FirstLedger(spark, path, schemas.DAU_INFO, ["dt", "mid"], partition="dt", order=["ts"])


def first_seen(page_logs: DataFrame, lateness: str = "1 day", salts: int = 8, clock: str | None = None) -> DataFrame:
    """The first landing seen per day and device.

    A key stays in state for ``lateness`` from its arrival (:func:`tidecart.operators.arrival.arrived`), whatever day it is of:
    no record is too late, and one dated in the future closes no day. A key that comes again after that passes here; the table
    keeps the first. Spark sends all rows of a key to one task, so a first pass on ``(day, device, salt)`` thins out a hot
    device on ``salts`` tasks and the second pass sees at most ``salts`` rows of it. Which of several landings in one batch is
    kept is not fixed; across batches it is the earlier batch's.
    """
    landed = (
        with_row_count(active_users.landings(with_row_count(page_logs, "pages")), "landings")
        .withColumn("arrived", arrived(clock))
        .withWatermark("arrived", lateness)
    )
    if salts > 1:
        salt = F.pmod(F.xxhash64("ts", "page_id"), F.lit(salts))
        landed = landed.withColumn("salt", salt).dropDuplicatesWithinWatermark(["dt", "mid", "salt"]).drop("salt")
    return landed.dropDuplicatesWithinWatermark(["dt", "mid"]).drop("arrived")


def handle_landings(
    batch: DataFrame,
    batch_id: int,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    table: FirstLedger,
    as_of=None,
    restore: bool = False,
) -> None:
    """Enrich the first landings of a batch and store them by day and device.

    With ``restore`` the stored devices of the batch's days are left out, for a query that starts over without
    its checkpoint.
    """
    batch.persist()
    try:
        if batch.isEmpty():
            return
        if restore:
            days = batch.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")).first()
            stored = table.read(before=batch_id, where=F.col("dt").between(days.lo, days.hi))
            batch = not_stored(batch, stored, ["dt", "mid"])
        users, provinces, small = dims_for(dims, batch, "user_id", "province_id")
        table.write(active_users.enrich(batch, users, provinces, as_of, small=small), batch_id)
    finally:
        batch.unpersist()


def start_daily_active(
    page_logs: DataFrame,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    table: FirstLedger,
    as_of=None,
    restore: bool = False,
    lateness: str = "1 day",
    salts: int = 8,
    clock: str | None = None,
    compact_every: int = 200,
    **options,
) -> StreamingQuery:
    """``dims`` is asked for every batch and gives the current users and provinces (:class:`CurrentDims`, or any function that
    returns both)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        handle_landings(batch, batch_id, dims, table, as_of, restore)

    return start(first_seen(page_logs, lateness, salts, clock), "daily_active", handle, tables=[table], compact_every=compact_every, **options)
