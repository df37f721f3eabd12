"""Session settings this package is tuned for. Nothing here is required for right results."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Above 2000 reducers Spark reports only average block sizes, which hides a hot key from the
    # skew-join rule; this keeps the exact size of blocks five times the median.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    # Plans are built anew for every micro-batch; without call-site capture that takes half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Day-long dedupe keys and 24 h join buffers can outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app_name: str = "tidecart", **overrides: str) -> SparkSession.Builder:
    """A session builder with :data:`SETTINGS`; ``overrides`` use ``__`` for the dots of a key."""
    result = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        result = result.config(key, value)
    for key, value in overrides.items():
        result = result.config(key.replace("__", "."), value)
    return result


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines reach: ``spark.checkpoint.dir``. Where it is unset, a local session (as in tests) gets a temporary
    one; on a cluster that is an error, since no other machine would see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder all machines can reach")
        folder = "file://" + tempfile.mkdtemp(prefix="tidecart-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of one streaming query under the cluster's shared folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set: pass a checkpoint folder all executors can reach")
    return f"{shared.rstrip('/')}/{name}"
