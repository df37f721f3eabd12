"""Split raw application logs into page, display, action, start and error records.

Input is any frame with a ``value`` text column. Every step is row-local: no shuffle, no skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.operators import routing
from tidecart.operators.parsing import evaluated_once

# Topic names.
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC"
START_TOPIC = "DWD_START_LOG_TOPIC"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC"
# Ours: messages that are not one JSON object of the expected shape.
DEAD_LETTER_TOPIC = "ODS_BASE_LOG_DEAD_LETTER"

# Device field to its key in the message.
_DEVICE_KEYS = {
    "mid": "mid",
    "user_id": "uid",
    "province_id": "ar",
    "channel": "ch",
    "is_new": "is_new",
    "model": "md",
    "operate_system": "os",
    "version_code": "vc",
    "brand": "ba",
}
# Page field to its key in the message.
_PAGE_KEYS = {
    "page_id": "page_id",
    "last_page_id": "last_page_id",
    "page_item": "item",
    "page_item_type": "item_type",
    "during_time": "during_time",
    "sourceType": "source_type",
}
# Display field to its key in the message.
_DISPLAY_KEYS = {
    "display_type": "display_type",
    "display_item": "item",
    "display_item_type": "item_type",
    "display_order": "order",
    "display_pos_id": "pos_id",
}
# Action field to its key in the message.
_ACTION_KEYS = {"action_id": "action_id", "action_item": "item", "action_item_type": "item_type", "action_ts": "ts"}
# Start field to its key in the message.
_START_KEYS = {
    "entry": "entry",
    "open_ad_id": "open_ad_id",
    "loading_time_ms": "loading_time",
    "open_ad_ms": "open_ad_ms",
    "open_ad_skip_ms": "open_ad_skip_ms",
}
_NUMBERS = {"during_time", "action_ts", "loading_time_ms", "open_ad_ms", "open_ad_skip_ms"}


def parse(raw: DataFrame) -> DataFrame:
    """``value`` and the parsed message ``log``."""
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    return evaluated_once(raw, F.from_json("value", schemas.ODS_LOG, options), "log", ["value"])


def is_dead() -> Column:
    """Empty text, text that is not a JSON object, or an object whose parts have another shape."""
    return F.col("log").isNull() | F.col(f"log.{schemas.CORRUPT}").isNotNull()


def is_error() -> Column:
    return ~is_dead() & F.col("log.err").isNotNull()


def is_good() -> Column:
    return ~is_dead() & F.col("log.err").isNull()


def _fields(source: Column, keys: dict[str, str]) -> list[Column]:
    return [
        (source[key].try_cast("bigint") if name in _NUMBERS else source[key]).alias(name) for name, key in keys.items()
    ]


def _ts() -> Column:
    return F.col("log.ts").try_cast("bigint").alias("ts")


def _page_fields() -> list[Column]:
    return _fields(F.col("log.common"), _DEVICE_KEYS) + _fields(F.col("log.page"), _PAGE_KEYS)


def page_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_good() & F.col("log.page").isNotNull()).select(*_page_fields(), _ts())


def display_logs(parsed: DataFrame) -> DataFrame:
    """One row per display of a page; displays without a page are ignored."""
    pages = parsed.where(is_good() & F.col("log.page").isNotNull())
    rows = pages.select("log", F.explode("log.displays").alias("item")).where(F.col("item").isNotNull())
    return rows.select(*_page_fields(), *_fields(F.col("item"), _DISPLAY_KEYS), _ts())


def action_logs(parsed: DataFrame) -> DataFrame:
    """One row per action on a page; actions without a page are ignored."""
    pages = parsed.where(is_good() & F.col("log.page").isNotNull())
    rows = pages.select("log", F.explode("log.actions").alias("item")).where(F.col("item").isNotNull())
    return rows.select(*_page_fields(), *_fields(F.col("item"), _ACTION_KEYS), _ts())


def start_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_good() & F.col("log.start").isNotNull()).select(
        *_fields(F.col("log.common"), _DEVICE_KEYS), *_fields(F.col("log.start"), _START_KEYS), _ts()
    )


def error_logs(parsed: DataFrame) -> DataFrame:
    """Messages with an error, whole; they feed no other output."""
    return parsed.where(is_error()).select("value")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_dead()).select("value")


def routed(raw: DataFrame) -> DataFrame:
    """``(value, route, reason)`` of every message."""
    empty = is_good() & F.col("log.page").isNull() & F.col("log.start").isNull()
    tagged = routing.routed(
        parse(raw), dead=routing.reasons(not_a_JSON_object=is_dead()), other=routing.reasons(no_page_start_or_error=empty)
    )
    return tagged.select("value", "route", "reason")


def split(raw: DataFrame) -> DataFrame:
    """All outputs as ``(topic, value)`` rows from one parse of each message.

    Records are JSON texts without their null fields.
    """

    def message(topic: str, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), value.alias("value"))

    def none() -> Column:
        return F.array().cast("array<struct<topic:string,value:string>>")

    def per_item(items: Column, topic: str, keys: dict[str, str]) -> Column:
        present = F.filter(F.coalesce(items, F.array().cast(items_type[topic])), lambda item: item.isNotNull())
        record = lambda item: F.to_json(F.struct(*_page_fields(), *_fields(item, keys), _ts()))
        return F.transform(present, lambda item: message(topic, record(item)))

    items_type = {
        DISPLAY_TOPIC: schemas.ODS_LOG["displays"].dataType.simpleString(),
        ACTION_TOPIC: schemas.ODS_LOG["actions"].dataType.simpleString(),
    }
    page = F.array(message(PAGE_TOPIC, F.to_json(F.struct(*_page_fields(), _ts()))))
    start_record = F.struct(*_fields(F.col("log.common"), _DEVICE_KEYS), *_fields(F.col("log.start"), _START_KEYS), _ts())
    start = F.array(message(START_TOPIC, F.to_json(start_record)))
    of_page = F.concat(
        page,
        per_item(F.col("log.displays"), DISPLAY_TOPIC, _DISPLAY_KEYS),
        per_item(F.col("log.actions"), ACTION_TOPIC, _ACTION_KEYS),
    )
    good = F.concat(
        F.when(F.col("log.page").isNotNull(), of_page).otherwise(none()),
        F.when(F.col("log.start").isNotNull(), start).otherwise(none()),
    )
    messages = (
        F.when(is_dead(), F.array(message(DEAD_LETTER_TOPIC, F.col("value"))))
        .when(is_error(), F.array(message(ERROR_TOPIC, F.col("value"))))
        .otherwise(good)
    )
    return parse(raw).select(F.explode(messages).alias("m")).select("m.topic", "m.value")
