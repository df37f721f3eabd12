"""Parse a text column once, and leniently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidecart.operators.routing import reasons, routed
from tidecart.schemas import CORRUPT


def evaluated_once(df: DataFrame, value: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and ``value`` as ``name``.

    Filters and projections that use ``name`` would each be given their own copy of the expression; behind a
    generator, which the optimizer does not move expressions across, a costly one is computed once per row.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def typed_records(raw: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The records of ``schema`` in the JSON texts of ``value``, and the ``keep`` columns of ``raw``.

    Fields are read as text and then cast, so a number may also come quoted; one that is no number is null. A text
    that is no JSON object gives no record.
    """
    fields = [*schema.names, *keep]
    return routed_records(raw, schema, keep=keep).where(F.col("route") == "stored").select(*fields)


def routed_records(raw: DataFrame, schema: StructType, required: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The records of ``schema`` in the texts of ``value``, beside ``value``, ``keep``, ``route`` and ``reason``: dead are texts
    that are no JSON object, and those without a ``required`` field."""
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields]).add(CORRUPT, StringType())
    parsed = F.from_json("value", texts, {"columnNameOfCorruptRecord": CORRUPT})
    records = evaluated_once(raw, parsed, "r", ["value", *keep])
    fields = [
        F.col(f"r.{f.name}") if f.dataType == StringType() else F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    missing = {f"no_{name}": F.col(name).isNull() for name in required}
    typed = records.select(*fields, "value", *keep, broken.alias("__broken"))
    dead = reasons(not_a_JSON_object=F.col("__broken"), **missing)
    return routed(typed, dead=dead).drop("__broken")
