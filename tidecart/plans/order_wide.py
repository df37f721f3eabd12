"""Order lines joined to their order header, with user and province attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecart import schemas
from tidecart.functions import times
from tidecart.operators import routing
from tidecart.operators.lookup import HOT_KEYS, fits_broadcast, heavy_keys, heavy_of, lookup
from tidecart.operators.merge import merge_by_name, prefixed
from tidecart.operators.parsing import routed_records, typed_records
from tidecart.plans.dimensions import with_province, with_user

# Output column to province column.
_PROVINCE_NAMES = {
    "province_name": "name",
    "province_area_code": "area_code",
    "province_3166_2_code": "iso_3166_2",
    "province_iso_code": "iso_code",
}
# Ours: texts that are no orders or lines, and lines whose order did not come.
DEAD_LETTER_TOPIC = "DWD_ORDER_DEAD_LETTER"
LATE_TOPIC = "DWD_ORDER_LATE"

_RENAMES = {"order__id": "order_id", "detail__id": "detail_id"}


def parse_orders(raw: DataFrame) -> DataFrame:
    """Order headers from their JSON texts in ``value``, with the arrival ``timestamp`` where the source has one."""
    return _records(raw, schemas.ORDER_INFO)


def parse_details(raw: DataFrame) -> DataFrame:
    """Order lines from their JSON texts in ``value``, with the arrival ``timestamp`` where the source has one."""
    return _records(raw, schemas.ORDER_DETAIL)


def _records(raw: DataFrame, schema: StructType) -> DataFrame:
    return typed_records(raw, schema, ["timestamp"] if "timestamp" in raw.columns else [])


def routed_orders(raw: DataFrame) -> DataFrame:
    """Every order text with its record, ``route`` and ``reason``: dead are texts that are no JSON objects or have no id."""
    return routed_records(raw, schemas.ORDER_INFO, ["id"])


def routed_details(raw: DataFrame, orders: DataFrame, within: str = "24 hours") -> DataFrame:
    """Every line text with its record, ``route`` and ``reason``: late are lines whose order is missing or was created more than
    ``within`` before or after."""
    lines = routed_records(raw, schemas.ORDER_DETAIL, ["id", "order_id"]).withColumnRenamed("reason", "__why")
    placed = [F.col("id").alias("__order"), F.col("create_time").alias("__created")]
    met = lookup(lines, orders, "order_id", "id", placed, ["id"])
    ordered, made = (times.timestamp_of_text(F.col(c)) for c in ("__created", "create_time"))
    span = F.expr(f"interval {within}")
    near = F.coalesce(made.between(ordered - span, ordered + span), F.lit(False))
    late = routing.reasons(no_order=F.col("__order").isNull(), order_too_far_in_time=~near)
    return routing.routed(met, dead=F.col("__why"), late=late).drop("__why", "__order", "__created")


def enrich_orders(
    orders: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | str | dt.date | None = None,
    prefix: str = "",
    spread_by: Sequence[str] = ("id",),
    **lookup_options,
) -> DataFrame:
    """Order headers with user, province, ``create_date`` and ``create_hour``; ``prefix`` stands before every name."""
    hot_keys = lookup_options.get("hot_keys", HOT_KEYS)
    if hot_keys and not orders.isStreaming:
        # Both lookups keep the rows, so one pass over the plain headers serves them.
        lookup_options["heavy"] = heavy_of(orders, f"{prefix}user_id", f"{prefix}province_id", hot_keys=hot_keys)
    with_dims = with_user(orders, users, spread_by, as_of, prefix, **lookup_options)
    with_dims = with_province(with_dims, provinces, spread_by, _PROVINCE_NAMES, prefix, **lookup_options)
    created = F.col(f"{prefix}create_time")
    return with_dims.withColumns(
        {f"{prefix}create_date": times.date_of_text(created), f"{prefix}create_hour": times.hour_of_text(created)}
    )


def merge(joined: DataFrame) -> DataFrame:
    """The 30-column record of a frame whose columns are prefixed ``order__`` and ``detail__``.

    Where both sides have a field the line wins, so ``create_time`` is the line's while ``create_date`` and
    ``create_hour`` come from the order.
    """
    return merge_by_name(joined, "order__", "detail__", schemas.ORDER_WIDE, _RENAMES)


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | str | dt.date | None = None,
    within: str | None = None,
    small: bool | None = None,
    hot_keys: int = HOT_KEYS,
    bare_details: DataFrame | None = None,
) -> DataFrame:
    """One row per order line that has its order.

    Headers are enriched before the join: there are fewer of them than lines. ``within`` (an interval such as
    ``"24 hours"``) keeps only pairs whose create times are at most that far apart. ``bare_details`` are the same lines before they
    were joined to anything (``order_id`` is enough): hot orders are then looked for there.
    """
    options = {"small": small, "hot_keys": hot_keys}
    enriched = prefixed(enrich_orders(orders, users, provinces, as_of, **options), "order__")
    lines = prefixed(details, "detail__")
    base = details if bare_details is None else bare_details
    line_keys = lambda key: heavy_keys(base, "order_id", k=hot_keys)["order_id"]
    if small is None:
        # Enrichment keeps the row count and adds a few short texts, so the plain headers answer the size check.
        small = fits_broadcast(orders)
    attributes = [F.col(c) for c in enriched.columns]
    joined = lookup(
        lines, enriched, "detail__order_id", "order__id", attributes, ["detail__id"], how="inner", small=small, hot_keys=hot_keys, heavy=line_keys
    )
    if within is not None:
        joined = joined.where(close_in_time(within))
    return merge(joined)


def close_in_time(within: str) -> Column:
    order_time = times.timestamp_of_text(F.col("order__create_time"))
    detail_time = times.timestamp_of_text(F.col("detail__create_time"))
    span = F.expr(f"interval {within}")
    return detail_time.between(order_time - span, order_time + span)


def full_match(
    orders: DataFrame, details: DataFrame, small: bool | None = None, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Full outer match on the order id, with ``order__`` and ``detail__`` columns.

    Adaptive execution cannot split a hot key of a full outer join, so it is composed of a left lookup, which is
    safe for hot keys, and the orders without lines.
    """
    left, right = prefixed(details, "detail__"), prefixed(orders, "order__")
    attributes = [F.col(c) for c in right.columns]
    options = {"small": small, "hot_keys": hot_keys}
    lines = lookup(left, right, "detail__order_id", "order__id", attributes, ["detail__id"], **options)
    alone = prefixed(orders_without_details(orders, details), "order__")
    return lines.unionByName(alone, allowMissingColumns=True)


def orders_without_details(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Audit: headers no line refers to."""
    # Distinct ids combine on the map side and leave the data partitioned for the join.
    with_lines = details.select(F.col("order_id").alias("id")).distinct()
    return orders.join(with_lines, "id", "left_anti")


def details_without_order(
    orders: DataFrame, details: DataFrame, small: bool | None = None, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Audit: lines whose order is missing."""
    return lookup(details, orders, "order_id", "id", [], ["id"], how="anti", small=small, hot_keys=hot_keys)
