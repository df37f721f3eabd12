"""Log split as a stream: stateless, one parse per message, one write for all topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidecart.plans import log_split
from tidecart.streaming.run import start


def start_log_split(raw: DataFrame, topics, **options) -> StreamingQuery:
    """``topics`` is a sink with ``write(messages, batch_id)`` and ``bind(run)``."""
    return start(log_split.split(raw), "log_split", topics.write, sinks=[topics], **options)
