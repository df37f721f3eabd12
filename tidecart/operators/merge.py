"""Merge two records by field name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def merge_by_name(
    joined: DataFrame, left: str, right: str, target: StructType, renames: dict[str, str] | None = None
) -> DataFrame:
    """Fill the fields of ``target`` from columns prefixed ``left`` and ``right``; where both have a field the right one wins.

    ``renames`` maps a prefixed column to the target field it fills. Fields found on neither side are nulls of their type.
    """
    columns = set(joined.columns)
    renamed = {new: old for old, new in (renames or {}).items()}
    blocked = set(renames or {})

    def source(name: str, kind: DataType):
        if name in renamed:
            return F.col(renamed[name])
        for prefix in (right, left):
            if prefix + name in columns and prefix + name not in blocked:
                return F.col(prefix + name)
        return F.lit(None).cast(kind)

    return joined.select(*[source(f.name, f.dataType).alias(f.name) for f in target.fields])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])
