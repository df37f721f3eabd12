"""One row per key without a ranking window.

``min``/``max`` over a struct combine on the map side, so a key that holds a third of all rows reaches the
shuffle as one row per task; a ``row_number`` window would send every row of it to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    return df.groupBy(*keys).agg(pick(row).alias("__row")).select(
        *[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    )


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; ties by the other columns, nulls first."""
    return _one_per_key(df, keys, order, F.min)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key; ties by the other columns, nulls lowest."""
    return _one_per_key(df, keys, order, F.max)
