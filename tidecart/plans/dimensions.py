"""Typed dimension tables and the attributes they add."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.functions import times
from tidecart.operators.lookup import lookup


def _typed(dims: DataFrame, table: str, schema) -> DataFrame:
    rows = dims.where(F.col("table_name") == table)
    return rows.select(F.from_json("data", schema).alias("r")).select("r.*")


def user_table(dims: DataFrame) -> DataFrame:
    """User rows ``(id, gender, birthday)`` of the dimension rows."""
    return _typed(dims, "USER_INFO", schemas.USER_INFO)


def province_table(dims: DataFrame) -> DataFrame:
    """Province rows ``(id, name, iso_code, iso_3166_2, area_code)`` of the dimension rows."""
    return _typed(dims, "BASE_PROVINCE", schemas.BASE_PROVINCE)


def with_user(
    facts: DataFrame,
    users: DataFrame,
    spread_by: Sequence[str],
    as_of: Column | str | dt.date | None = None,
    prefix: str = "",
    **lookup_options,
) -> DataFrame:
    """Add ``user_gender`` and ``user_age``; both null for an anonymous or unknown user.

    ``prefix`` is put before the names of the fact key and of the new columns.
    """
    attributes = [
        F.col("gender").alias(f"{prefix}user_gender"),
        times.age_years(F.col("birthday"), as_of).alias(f"{prefix}user_age"),
    ]
    return lookup(facts, users, f"{prefix}user_id", "id", attributes, spread_by, **lookup_options)


def with_province(
    facts: DataFrame,
    provinces: DataFrame,
    spread_by: Sequence[str],
    names: dict[str, str],
    prefix: str = "",
    **lookup_options,
) -> DataFrame:
    """Add province attributes; ``names`` maps an output column to a province column."""
    attributes = [F.col(source).alias(f"{prefix}{name}") for name, source in names.items()]
    return lookup(facts, provinces, f"{prefix}province_id", "id", attributes, spread_by, **lookup_options)
