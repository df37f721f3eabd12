"""Daily active users: the first landing page of a device per day, with user and province attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.functions import times
from tidecart.operators import routing
from tidecart.operators.lookup import HOT_KEYS, heavy_of
from tidecart.operators.membership import not_stored
from tidecart.operators.parsing import routed_records, typed_records
from tidecart.operators.pick import first_by_key
from tidecart.plans.dimensions import with_province, with_user

# Output column to province column.
_PROVINCE_NAMES = {
    "province_name": "name",
    "province_iso_code": "iso_code",
    "province_3166_2": "iso_3166_2",
    "province_area_code": "area_code",
}


def parse(raw: DataFrame) -> DataFrame:
    """Page records from their JSON texts in ``value``."""
    return typed_records(raw, schemas.PAGE_LOG)


def routed(raw: DataFrame) -> DataFrame:
    """Every page text with its record, ``route`` and ``reason``: other are pages that open no visit."""
    pages = routed_records(raw, schemas.PAGE_LOG, ["mid", "ts"]).withColumnRenamed("reason", "__why")
    inner = routing.reasons(opens_no_visit=F.col("last_page_id").isNotNull())
    return routing.routed(pages, dead=F.col("__why"), other=inner).drop("__why")


def landings(page_logs: DataFrame) -> DataFrame:
    """Pages that open a visit, with their day."""
    return page_logs.where(F.col("last_page_id").isNull()).withColumn("dt", times.day_of_ms(F.col("ts")))


def first_landings(landed: DataFrame) -> DataFrame:
    """The earliest landing per day and device."""
    return first_by_key(landed, ["dt", "mid"], ["ts"])


def enrich(
    landed: DataFrame, users: DataFrame, provinces: DataFrame, as_of: Column | str | dt.date | None = None, **lookup_options
) -> DataFrame:
    """The 23-column day record of one landing per day and device."""
    spread = ["mid", "ts"]
    hot_keys = lookup_options.get("hot_keys", HOT_KEYS)
    if hot_keys and not landed.isStreaming:
        lookup_options["heavy"] = heavy_of(landed, "user_id", "province_id", hot_keys=hot_keys)
    with_dims = with_user(landed, users, spread, as_of, **lookup_options)
    with_dims = with_province(with_dims, provinces, spread, _PROVINCE_NAMES, **lookup_options)
    return with_dims.withColumn("hr", times.hour_of_ms(F.col("ts"))).select(*schemas.DAU_INFO.names)


def daily_active(
    page_logs: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    as_of: Column | str | dt.date | None = None,
    stored: DataFrame | None = None,
    hot_keys: int = 0,
    **lookup_options,
) -> DataFrame:
    """Page records to day records. Devices already in ``stored`` for their day are left out.

    A search for hot users would read and reduce all page records once more, so it is off unless ``hot_keys`` is
    given; null users are spread in any case.
    """
    first = first_landings(landings(page_logs))
    if stored is not None:
        first = not_stored(first, stored, ["dt", "mid"])
    return enrich(first, users, provinces, as_of, hot_keys=hot_keys, **lookup_options)
