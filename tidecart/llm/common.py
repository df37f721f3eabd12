"""Helpers of the training-data operators: shared folder, whole-text tokens, hashes, samples."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecart.session import shared_folder
from tidecart.sources.folders import remove


#: Rows of a batch handed to Python in ``small_batches``. Spark's ten thousand, of texts or sketches, are held as JVM buffers outside
#: the heap and once more by the worker, for each task at a time.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python in batches of ``BATCH_ROWS`` at most."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS if int(before) <= 0 else min(BATCH_ROWS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, *read: DataFrame | None, free: bool = False) -> DataFrame:
    """``df`` written as a table to the shared folder and read back: later steps neither recompute it nor lose it
    with an executor. ``read`` are stored tables that nothing reads after this; they are deleted. With ``free`` the shuffle files of
    finished steps go too: Spark keeps them until the driver collects its garbage, which a long job would wait for in vain."""
    spark = df.sparkSession
    path, schema = f"{shared_folder(spark)}/tidecart-{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    dropped(*read)
    if free:
        del df
        gc.collect()
        spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def dropped(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        if table is not None:
            for file in table.inputFiles()[:1]:
                folder = file.rsplit("/", 1)[0]
                if folder.rsplit("/", 1)[-1].startswith("tidecart-"):
                    remove(table.sparkSession, folder)


def slices(spark: SparkSession) -> int:
    """Partitions for work that no key deals out: as many as shuffles use."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc(column: str) -> Column:
    """crc32 of an id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def row_key(*columns: str) -> Column:
    """A key that tells rows with one id but different contents apart; exact repeats share it and their results."""
    return F.xxhash64(*[F.col(c) for c in columns])


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values (the finalizer of the public-domain splitmix generator)."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class Sums:
    """Polynomial hashes, modulo 2**64, of any ranges of a sequence of 64-bit values, from prefix sums."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int = 0xD6E8FEB86659FD93):
        n = len(values)
        if len(self._powers.get(base, [[]])[0]) <= n:
            size = max(1 << 16, 2 * n)
            with np.errstate(over="ignore"):
                up, down = (np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
                up[0] = down[0] = 1
                self._powers[base] = np.cumprod(up), np.cumprod(down)
        up, self.down = self._powers[base]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWERED = np.arange(256, dtype=np.uint64) + 1
_LOWERED[65:91] += 32
_PLAIN = np.arange(256, dtype=np.uint64) + 1


def hashed_words(column, lower: bool, block: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of a binary Arrow column, without making the words: for blocks of rows ``low`` to ``high`` (about ``block`` bytes)
    the hashes of all words (runs of other than ASCII white space) and, per row, where its words begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + block, "right")) - 1)
        part = data[offsets[low] : offsets[high]]
        begins = offsets[low : high + 1] - offsets[low]
        edge = np.zeros(len(part) + 1, bool)  # a text begins here
        edge[begins] = True
        inside = ~_WHITE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        values = Sums((_LOWERED if lower else _PLAIN)[part]).of(start, end)
        with np.errstate(over="ignore"):
            values = mixed(values + (end - start).astype(np.uint64))
        yield low, high, values, np.searchsorted(start, begins)
        low = high


def pieces(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``size`` bytes in a text column, a row at least. A batch of Spark's holds ten thousand rows
    of any length; made into Python objects and a batch of results at once, they weigh several times as much."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(low, high - low)
        low = high


def sample_by_hash(df: DataFrame, key: str, rows: int, per: str | None = None) -> DataFrame:
    """At most ``rows`` rows (of each value of ``per``) by smallest hash of the key: the same rows on every run. Hashes are first
    counted by their leading 16 bits; only rows up to the slot in which a group reaches ``rows`` are ranked, so no group is
    gathered whole."""
    hashed = F.xxhash64(F.col(key).cast("string"))
    by = [hashed, F.col(key)]
    if per is None:
        return df.orderBy(*by).limit(rows)
    slot = F.shiftright(hashed, 48)
    counts = df.groupBy(F.col(per).alias("_per"), slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_per").orderBy("_slot")) - F.col("_n")
    ends = counts.withColumn("_before", before).where(F.col("_before") < rows).groupBy("_per").agg(F.max("_slot").alias("_end"))
    near = df.join(small(stored(ends), 64), F.col(per).eqNullSafe(F.col("_per"))).where(slot <= F.col("_end")).drop("_per", "_end")
    ranked = near.withColumn("_rank", F.row_number().over(Window.partitionBy(per).orderBy(*by)))
    return ranked.where(F.col("_rank") <= rows).drop("_rank")


#: A table is broadcast only if it is measured to be at most this large.
BROADCAST_BYTES = 16 << 20


def small(table: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``table`` (stored), marked for broadcast if its measured size allows; beyond that Spark joins by shuffle."""
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else table


def schema_with(df: DataFrame, **fields: str) -> StructType:
    """The schema of ``df`` and more fields, as a new object."""
    result = StructType(list(df.schema.fields))
    for name, kind in fields.items():
        result = result.add(name, kind)
    return result
