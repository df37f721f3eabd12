"""Order wide table as a stream: a two-sided join that waits for the later side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecart import schemas
from tidecart.operators.arrival import arrived
from tidecart.operators.merge import prefixed
from tidecart.plans import order_wide
from tidecart.sinks.ledger import KeyedLedger
from tidecart.streaming.change_capture import dims_for
from tidecart.streaming.run import start

# Fixed value: how long one side waits for the other, from its arrival on.
WAIT = "24 hours"


def wide_ledger(spark: SparkSession, path: str) -> KeyedLedger:
    """Wide rows by line id within the order's day: exactly one row per line, also after a replay."""
    return KeyedLedger(spark, path, schemas.ORDER_WIDE, ["create_date", "detail_id"], partition="create_date")


def _arriving(df: DataFrame, prefix: str, clock: str | None, lateness: str) -> DataFrame:
    timed = df.withColumn("arrived", arrived(clock)).drop("timestamp")
    return prefixed(timed, prefix).withWatermark(f"{prefix}arrived", lateness)


def _meet(wait: str, within: str | None) -> Column:
    """The same order, and arrivals at most ``wait`` apart; with ``within`` also create times, where both parse."""
    span = F.expr(f"interval {wait}")
    condition = (F.col("detail__order_id") == F.col("order__id")) & F.col("detail__arrived").between(
        F.col("order__arrived") - span, F.col("order__arrived") + span
    )
    if within is None:
        return condition
    return condition & F.coalesce(order_wide.close_in_time(within), F.lit(True))


def _salted(details: DataFrame, salts: int) -> DataFrame:
    return details.withColumn("detail__salt", F.pmod(F.xxhash64("detail__id"), F.lit(salts)))


def paired(
    orders: DataFrame,
    details: DataFrame,
    wait: str = WAIT,
    within: str | None = None,
    lateness: str = "10 minutes",
    salts: int = 8,
    how: str = "inner",
    clock: str | None = None,
) -> DataFrame:
    """Lines with their order in either arrival order, if the second comes at most ``wait`` after the first.

    The wait goes by arrival (:func:`tidecart.operators.arrival.arrived`), so that what a row says about its own time neither
    ends another row's wait nor its own. ``lateness`` is how far the rows of a ``clock`` column may come out of order. The
    watermark drops a waiting row from state once no partner can come any more. All lines of an order would meet in one task:
    lines take one of ``salts`` salts and the order is copied once per salt, so a huge order is spread. ``how="left_outer"``
    also gives the lines that stayed alone (order columns null). ``within`` also bounds the distance of create times.
    """
    left = _arriving(details, "detail__", clock, lateness)
    right = _arriving(orders, "order__", clock, lateness)
    condition = _meet(wait, within)
    if salts > 1:
        left = _salted(left, salts)
        copies = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        right = right.withColumn("order__salt", F.explode(copies))
        condition = condition & (F.col("detail__salt") == F.col("order__salt"))
    return left.join(right, condition, how)


def lonely_details(orders: DataFrame, details: DataFrame, **options) -> DataFrame:
    """Late output: lines whose order did not come in time."""
    joined = paired(orders, details, how="left_outer", **options).where(F.col("order__id").isNull())
    return joined.select([F.col(f"detail__{c}").alias(c) for c in details.columns if c != "timestamp"])


def lonely_orders(
    orders: DataFrame,
    details: DataFrame,
    wait: str = WAIT,
    within: str | None = None,
    lateness: str = "10 minutes",
    salts: int = 8,
    clock: str | None = None,
) -> DataFrame:
    """Late output: orders none of whose lines came in time.

    One copy of an order decides, so its lines are thinned out first, to one per salt while they wait.
    """
    left = _arriving(orders, "order__", clock, lateness)
    columns = ["id", "order_id", *[c for c in ("create_time", "timestamp") if c in details.columns]]
    right = _salted(_arriving(details.select(*columns), "detail__", clock, lateness), salts)
    if within is None:
        # Without a bound on create times the lines of an order are alike.
        right = right.dropDuplicatesWithinWatermark(["detail__order_id", "detail__salt"])
    joined = left.join(right, _meet(wait, within), "left_outer").where(F.col("detail__order_id").isNull())
    return joined.select([F.col(f"order__{c}").alias(c) for c in orders.columns if c != "timestamp"])


def handle_pairs(batch: DataFrame, batch_id: int, dims: Callable[[], tuple[DataFrame, DataFrame]], table: KeyedLedger, as_of=None) -> None:
    batch.persist()
    try:
        if batch.isEmpty():
            return
        users, provinces, small = dims_for(dims, batch, "order__user_id", "order__province_id")
        enriched = order_wide.enrich_orders(batch, users, provinces, as_of, "order__", ["detail__id"], small=small)
        table.write(order_wide.merge(enriched), batch_id)
    finally:
        batch.unpersist()


def start_order_wide(
    orders: DataFrame,
    details: DataFrame,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    table: KeyedLedger,
    as_of=None,
    wait: str = WAIT,
    within: str | None = None,
    lateness: str = "10 minutes",
    salts: int = 8,
    clock: str | None = None,
    compact_every: int = 200,
    **options,
) -> StreamingQuery:
    """``dims`` is asked for every batch and gives the current users and provinces (:class:`CurrentDims`, or any function that
    returns both)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        handle_pairs(batch, batch_id, dims, table, as_of)

    pairs = paired(orders, details, wait, within, lateness, salts, clock=clock)
    return start(pairs, "order_wide", handle, tables=[table], compact_every=compact_every, **options)


def start_order_late(orders: DataFrame, details: DataFrame, topics, checkpoint: str, **options) -> tuple[StreamingQuery, StreamingQuery]:
    """Late outputs: lines whose order, and orders none of whose lines came within the wait, to ``LATE_TOPIC`` with the reason.

    ``options`` are those of :func:`lonely_details` and :func:`lonely_orders`, and of :func:`tidecart.streaming.run.start`. The two
    queries keep their checkpoints below ``checkpoint`` and write under runs of their own, so ``topics`` is a function that
    gives each its sink.
    """
    joined = {k: options.pop(k) for k in ("wait", "within", "lateness", "salts", "clock") if k in options}
    found = {
        "no order came": lonely_details(orders, details, **joined),
        "no line came": lonely_orders(orders, details, **joined),
    }

    def begin(reason: str, rows: DataFrame) -> StreamingQuery:
        sink = topics()
        letter = F.to_json(F.struct(F.lit(reason).alias("reason"), F.to_json(F.struct(*rows.columns)).alias("value")))
        letters = rows.select(F.lit(order_wide.LATE_TOPIC).alias("topic"), letter.alias("value"))
        name = reason.replace(" ", "_")
        return start(letters, name, sink.write, checkpoint=f"{checkpoint}/{name}", sinks=[sink], **options)

    return tuple(begin(reason, rows) for reason, rows in found.items())
