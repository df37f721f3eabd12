"""Start a streaming query whose batches go to a function."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidecart.operators import routing
from tidecart.session import checkpoint_location

# Fixed value: batch interval.
INTERVAL = "5 seconds"


class Upkeep:
    """Compacts and vacuums tables beside the batches of a query, once in ``every`` batches, one run at a time."""

    def __init__(self, tables: Sequence, every: int):
        self.tables, self.every = tables, every
        self.thread = ThreadPoolExecutor(1, "upkeep")
        self.running: Future | None = None

    def _work(self) -> None:
        for table in self.tables:
            table.compact()
            table.vacuum()

    def after(self, batch_id: int) -> None:
        """Start in the background unless the last one still runs. Its failure fails the batch that would start the next."""
        if not self.every or (batch_id + 1) % self.every or (self.running and not self.running.done()):
            return
        self.wait()
        self.running = self.thread.submit(self._work)

    def wait(self) -> None:
        if self.running:
            self.running.result()


def start(
    df: DataFrame,
    name: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    interval: str = INTERVAL,
    available_now: bool = False,
    mode: str = "append",
    tables: Sequence = (),
    compact_every: int = 0,
    sinks: Sequence = (),
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` for every batch, in batches of ``interval`` or until the input is used up.

    The checkpoint records the input of a batch before it runs and its commit after it, so a restarted query
    repeats at most the last batch, with the same rows and the same id; ``handle`` must be safe to repeat.
    ``tables`` are the ledgers it writes: before the first batch they are bound to the checkpoint's own id, which closes them
    to any query that wrote them before; ``sinks`` are bound to it too. ``compact_every`` batches they are compacted in the background; ``query.upkeep`` can be
    waited for.
    """
    started, query_id = threading.Event(), []
    upkeep = Upkeep(tables, compact_every)

    def bound(batch: DataFrame, batch_id: int) -> None:
        if not bound.done:
            started.wait()
            for table in [*tables, *sinks]:
                table.bind(query_id[0])
            bound.done = True
        handle(batch, batch_id)
        upkeep.after(batch_id)

    bound.done = False
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    query = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, name))
        .foreachBatch(bound)
        .trigger(**trigger)
        .start()
    )
    query.upkeep = upkeep
    query_id.append(str(query.id))
    started.set()
    return query


def start_dead_letters(raw: DataFrame, routed: Callable[[DataFrame], DataFrame], topic: str, topics, **options) -> StreamingQuery:
    """The dead rows of ``raw`` to ``topic``, for steps that keep state and so see sound records only. ``routed`` gives every row
    its route; the accounts of each batch are metrics of the query."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        topics.write(routing.dead_letters(batch, topic), batch_id)

    return start(routing.watched(routed(raw)), f"{topic.lower()}_stream", handle, sinks=[topics], **options)
