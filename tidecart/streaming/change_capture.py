"""Change events as a stream: facts to topics, dimensions to a keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecart import schemas
from tidecart.operators import routing
from tidecart.operators.lookup import fits_broadcast
from tidecart.plans import change_capture, dimensions
from tidecart.sinks.ledger import KeyedLedger
from tidecart.streaming.run import start


def dim_ledger(spark: SparkSession, path: str) -> KeyedLedger:
    """Dimension rows by table and id. The source order decides, so late older changes do not win."""
    return KeyedLedger(spark, path, schemas.DIM_ROWS, ["table_name", "id"], partition="table_name", order=["seq"])


class CurrentDims:
    """The current users and provinces for the steps that look them up.

    Called without arguments it gives the whole tables; :meth:`near` only the rows that a batch refers to, so that the work of
    a batch goes with its own keys and a scan of the key column, not with a reduction of all dimension rows.
    """

    def __init__(self, dims: KeyedLedger, drop_deleted: bool = False):
        self.dims, self.drop_deleted = dims, drop_deleted

    def __call__(self) -> tuple[DataFrame, DataFrame]:
        return current_dims(self.dims, self.drop_deleted)

    def near(self, batch: DataFrame, user: str, province: str) -> tuple[DataFrame, DataFrame, bool]:
        """``(users, provinces, small)`` for the keys in the named columns of ``batch``; ``small`` if they are known to be few."""
        keys = batch.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.col(column).cast("string").alias("id"))
            for table, column in (("USER_INFO", user), ("BASE_PROVINCE", province))
        ])).alias("k")).select("k.*").where(F.col("id").isNotNull()).distinct()
        small = fits_broadcast(keys)

        def rows(table: str) -> DataFrame:
            of_table = keys.where(F.col("table_name") == table).select("id")
            current = self.dims.read(part=table, only=F.broadcast(of_table) if small else of_table)
            return current.where(F.col("op") != "D") if self.drop_deleted else current

        return dimensions.user_table(rows("USER_INFO")), dimensions.province_table(rows("BASE_PROVINCE")), small


def dims_for(dims, batch: DataFrame, user: str, province: str) -> tuple[DataFrame, DataFrame, bool | None]:
    """Users and provinces for a batch from ``dims``: those it refers to where ``dims`` can tell, else all; and whether they are
    few (none if that is not known)."""
    near = getattr(dims, "near", None)
    return near(batch, user, province) if near else (*dims(), None)


def current_dims(dims: KeyedLedger, drop_deleted: bool = False) -> tuple[DataFrame, DataFrame]:
    """The current users and provinces, each read from its own folder."""

    def rows(table: str) -> DataFrame:
        current = dims.read(where=F.col("table_name") == table)
        return current.where(F.col("op") != "D") if drop_deleted else current

    return dimensions.user_table(rows("USER_INFO")), dimensions.province_table(rows("BASE_PROVINCE"))


def handle_changes(batch: DataFrame, batch_id: int, roles: DataFrame, topics, dims: KeyedLedger) -> None:
    """Facts and dead letters go to topics in one write, dimension rows to their table; texts are parsed once."""
    routed = change_capture.routed(batch, roles).persist()
    try:
        changes = routed.where(F.col("route") == routing.STORED)
        dead = routing.dead_letters(routed, change_capture.DEAD_LETTER_TOPIC)
        topics.write(change_capture.fact_messages(changes, roles).unionByName(dead), batch_id)
        dims.write(change_capture.dim_changes(changes, roles), batch_id)
    finally:
        routed.unpersist()


def start_change_capture(
    raw: DataFrame,
    roles: Callable[[], DataFrame],
    topics,
    dims: KeyedLedger,
    compact_every: int = 200,
    **options,
) -> StreamingQuery:
    """``roles`` is called for every batch, so a changed table list applies from the next batch on."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        handle_changes(batch, batch_id, roles(), topics, dims)

    return start(raw, "change_capture", handle, tables=[dims], sinks=[topics], compact_every=compact_every, **options)
