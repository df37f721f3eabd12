"""Route database change events: fact rows to topics, dimension rows to a latest-by-id table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.operators import routing
from tidecart.operators.lookup import fits_broadcast
from tidecart.operators.membership import listed
from tidecart.operators.parsing import evaluated_once
from tidecart.operators.pick import latest_by_key

FACT, DIM = "fact", "dim"
# Ours: texts that are no change events.
DEAD_LETTER_TOPIC = "ODS_BASE_DB_DEAD_LETTER"
_LAST = 2**63 - 1


def op_code(kind: Column) -> Column:
    """Insert and bootstrap insert to I, update to U, delete to D, anything else to null."""
    return (
        F.when(kind.isin("insert", "bootstrap-insert"), "I").when(kind == "update", "U").when(kind == "delete", "D")
    )


def _events(raw: DataFrame) -> DataFrame:
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    kept = [c for c in ("value", "offset") if c in raw.columns]
    return evaluated_once(raw, F.from_json("value", schemas.CDC_ENVELOPE, options), "e", kept)


def parse(raw: DataFrame) -> DataFrame:
    """Row changes ``(table_name, op, data, seq)`` of a frame with a ``value`` text column.

    ``seq`` orders the changes: source second, transaction, offset in it (the event that closes a transaction has none and
    comes last), and the place in the source topic where the frame has an ``offset`` column.
    Events other than row changes are dropped, and so are texts that are not change events.
    """
    return _changes(raw).where(~F.col("broken") & F.col("op").isNotNull()).drop("value", "broken")


def _changes(raw: DataFrame) -> DataFrame:
    """``(value, broken, table_name, op, data, seq)`` of every text."""
    broken = F.col("e").isNull() | F.col("e")[schemas.CORRUPT].isNotNull()
    number = lambda name, missing: F.coalesce(F.col(name).try_cast("bigint"), F.lit(missing))
    arrived = F.col("offset").cast("bigint") if "offset" in raw.columns else F.lit(0).cast("bigint")
    return (
        _events(raw)
        .select(
            "value",
            broken.alias("broken"),
            F.col("e.table").alias("table_name"),
            op_code(F.col("e.type")).alias("op"),
            F.col("e.data").alias("data"),
            F.struct(
                number("e.ts", 0).alias("ts"),
                number("e.xid", -1).alias("xid"),
                number("e.xoffset", _LAST).alias("xoffset"),
                arrived.alias("arrived"),
            ).alias("seq"),
        )
    )


def routed(raw: DataFrame, roles: DataFrame) -> DataFrame:
    """Every text with its change (:func:`parse`), ``route`` and ``reason``: dead are texts that are no change events and
    dimension rows without an id; other are events that change no row, and tables in no role."""
    known = roles.where(F.col("role").isin(FACT, DIM)).groupBy("table_name").agg(F.max(F.col("role") == DIM).alias("__dim"))
    known = known.withColumnRenamed("table_name", "__known")
    if fits_broadcast(known):
        known = F.broadcast(known)
    changes = _changes(raw).join(known, F.col("table_name") == F.col("__known"), "left")
    no_id = F.col("op").isNotNull() & F.col("__dim") & F.get_json_object("data", "$.id").isNull()
    tagged = routing.routed(
        changes,
        dead=routing.reasons(not_a_change_event=F.col("broken"), no_id=no_id),
        other=routing.reasons(no_row_change=F.col("op").isNull(), table_in_no_role=F.col("__known").isNull()),
    )
    return tagged.drop("__known", "__dim", "broken")


def dead_letters(raw: DataFrame) -> DataFrame:
    """Texts that are not one JSON object of the expected shape."""
    return _changes(raw).where("broken").select("value")


def _in_role(changes: DataFrame, roles: DataFrame, role: str) -> DataFrame:
    return listed(changes, "table_name", roles.where(F.col("role") == role), "table_name")


def fact_messages(changes: DataFrame, roles: DataFrame) -> DataFrame:
    """``(topic, value)`` with topic ``DWD_<TABLE>_<OP>`` for tables in the fact role."""
    topic = F.concat_ws("_", F.lit("DWD"), F.upper("table_name"), F.col("op"))
    return _in_role(changes, roles, FACT).select(topic.alias("topic"), F.col("data").alias("value"))


def dim_changes(changes: DataFrame, roles: DataFrame) -> DataFrame:
    """``(table_name, id, data, op, seq)`` for tables in the dimension role."""
    return _in_role(changes, roles, DIM).select(
        F.upper("table_name").alias("table_name"), F.get_json_object("data", "$.id").alias("id"), "data", "op", "seq"
    )


def latest_dims(changes: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """The newest row per ``(table_name, id)``. A delete keeps its row unless ``drop_deleted``."""
    latest = latest_by_key(changes, ["table_name", "id"], ["seq"])
    return latest.where(F.col("op") != "D") if drop_deleted else latest
