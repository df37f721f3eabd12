"""Kafka as a stream, a bounded read and a sink.

Needs the ``spark-sql-kafka`` package on the class path. Every step downstream takes any frame with a ``value``
text column, so files serve as well.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _offsets(topic: str, offsets: str | dict[int, int]) -> str:
    """``latest``, ``earliest``, or the JSON form of explicit partition offsets."""
    if isinstance(offsets, str):
        return offsets
    return json.dumps({topic: {str(partition): offset for partition, offset in sorted(offsets.items())}})


def source_options(
    servers: str,
    topic: str,
    starting: str | dict[int, int] = "latest",
    group_prefix: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` only counts for a new query: a restarted one resumes from its checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": _offsets(topic, starting),
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of one topic as they arrive."""
    return _as_text(spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load())


def read(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str | dict[int, int] = "earliest",
    ending: str | dict[int, int] = "latest",
) -> DataFrame:
    """Messages of one topic between two offsets, for backfill."""
    options = source_options(servers, topic, starting) | {"endingOffsets": _offsets(topic, ending)}
    return _as_text(spark.read.format("kafka").options(**options).load())


def sink_options(servers: str) -> dict[str, str]:
    """Producer options: wait for all replicas, retry without duplicates."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }
