"""Topic sinks for ``(topic, value)`` or ``(topic, key, value)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.schemas import TOPIC_ROWS
from tidecart.sources.files import read_table
from tidecart.sources.kafka import sink_options


class KafkaTopics:
    """Append to the topic named in each row. Replayed batches may repeat messages, as with any Kafka append."""

    def __init__(self, servers: str):
        self.options = sink_options(servers)

    def bind(self, run: str) -> None:
        """Nothing to do: a topic only grows."""

    def write(self, messages: DataFrame, batch_id: int) -> None:
        messages.write.format("kafka").options(**self.options).save()


class FileTopics:
    """The same rows as parquet files under ``run=<r>/batch_id=<n>/topic=<t>``; a replayed batch of a run (one per checkpoint)
    replaces its own folder and no other run's."""

    def __init__(self, path: str, run: str = "default"):
        self.path = path.rstrip("/")
        self.run = run

    def bind(self, run: str) -> None:
        self.run = run

    def write(self, messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{self.path}/run={self.run}/batch_id={batch_id}")

    def read(self, spark: SparkSession, topic: str | None = None) -> DataFrame:
        rows = read_table(spark, self.path, TOPIC_ROWS)
        return rows if topic is None else rows.where(F.col("topic") == topic)
