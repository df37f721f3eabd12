"""Semi and anti joins against key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.operators.lookup import fits_broadcast


def listed(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``column`` is in ``keys.key``; the list is broadcast when it is proven small."""
    list_side = keys.select(F.col(key).alias("__listed"))
    if fits_broadcast(list_side):
        list_side = F.broadcast(list_side)
    return df.join(list_side, F.col(column) == F.col("__listed"), "left_semi")


def not_listed(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``column`` is not in ``keys.key``; a null column is kept.

    Apply it to counts rather than to raw rows: one hot key is then a handful of rows.
    """
    list_side = keys.select(F.col(key).alias("__listed"))
    return df.join(list_side, F.col(column) == F.col("__listed"), "left_anti")


def not_stored(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not already in ``stored``, for restoring a dedupe from its sink."""
    return df.join(stored.select(*keys), keys, "left_anti")
