"""Record layouts. Field names and their order are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType()}


def _ddl(*parts: str, **nested: DataType) -> StructType:
    """A struct from ``"name type, ..."`` texts and nested fields. Unlike a DDL parse it needs no session."""
    fields = [field.split() for part in parts for field in part.split(", ")]
    flat = [StructField(name, _TYPES[kind]) for name, kind in fields]
    return StructType([StructField(name, kind) for name, kind in nested.items()] + flat)


def _texts(names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names.split()])


# --- fixed values: record fields -------------------------------------------------------------

_DEVICE = (
    "mid string, user_id string, province_id string, channel string, is_new string, "
    "model string, operate_system string, version_code string, brand string"
)
_PAGE = "page_id string, last_page_id string, page_item string, page_item_type string, during_time bigint, sourceType string"

PAGE_LOG = _ddl(_DEVICE, _PAGE, "ts bigint")

PAGE_DISPLAY_LOG = _ddl(
    _DEVICE,
    _PAGE,
    "display_type string, display_item string, display_item_type string, display_order string, display_pos_id string",
    "ts bigint",
)

PAGE_ACTION_LOG = _ddl(
    _DEVICE, _PAGE, "action_id string, action_item string, action_item_type string, action_ts bigint", "ts bigint"
)

START_LOG = _ddl(
    _DEVICE, "entry string, open_ad_id string, loading_time_ms bigint, open_ad_ms bigint, open_ad_skip_ms bigint", "ts bigint"
)

DAU_INFO = _ddl(
    _DEVICE,
    "page_id string, page_item string, page_item_type string, sourceType string, during_time bigint",
    "user_gender string, user_age int",
    "province_name string, province_iso_code string, province_3166_2 string, province_area_code string",
    "dt string, hr string, ts bigint",
)

ORDER_INFO = _ddl(
    "id bigint, province_id bigint, order_status string, user_id bigint",
    "total_amount double, activity_reduce_amount double, coupon_reduce_amount double, original_total_amount double",
    "feight_fee double, feight_fee_reduce double",
    "expire_time string, refundable_time string, create_time string, operate_time string",
)

ORDER_DETAIL = _ddl(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, sku_name string, create_time string",
    "split_total_amount double, split_activity_amount double, split_coupon_amount double",
)

ORDER_WIDE = _ddl(
    "detail_id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, sku_name string",
    "split_total_amount double, split_activity_amount double, split_coupon_amount double",
    "province_id bigint, order_status string, user_id bigint",
    "total_amount double, activity_reduce_amount double, coupon_reduce_amount double, original_total_amount double",
    "feight_fee double, feight_fee_reduce double",
    "expire_time string, refundable_time string, create_time string, operate_time string",
    "create_date string, create_hour string",
    "province_name string, province_area_code string, province_3166_2_code string, province_iso_code string",
    "user_age int, user_gender string",
)

USER_INFO = _ddl("id string, gender string, birthday string")

BASE_PROVINCE = _ddl("id string, name string, iso_code string, iso_3166_2 string, area_code string")

AD_CLICK = _ddl("ts string, area string, city string, user string, ad string")

# --- raw messages: every scalar is read as text and cast later, so "12" and 12 both pass ------

CORRUPT = "_corrupt_record"

ODS_LOG = _ddl(
    f"err string, ts string, {CORRUPT} string",
    common=_texts("ar uid os ch is_new md mid vc ba"),
    page=_texts("page_id item item_type during_time last_page_id source_type"),
    displays=ArrayType(_texts("display_type item item_type pos_id order")),
    actions=ArrayType(_texts("action_id item item_type ts")),
    start=_texts("entry open_ad_id loading_time open_ad_ms open_ad_skip_ms"),
)

CDC_ENVELOPE = _ddl("type string, table string, ts string, xid string, xoffset string, data string", f"{CORRUPT} string")

# --- tables kept by this package --------------------------------------------------------------

TABLE_ROLES = _ddl("table_name string, role string")
DIM_ROWS = _ddl("table_name string, id string, data string, op string", seq=_ddl("ts bigint, xid bigint, xoffset bigint, arrived bigint"))
BLACK_LIST = _ddl("userid string")
USER_AD_COUNT = _ddl("dt string, userid string, adid string, count bigint")
AREA_CITY_AD_COUNT = _ddl("dt string, area string, city string, adid string, count bigint")
TOPIC_ROWS = _ddl("key string, value string, run string, batch_id bigint, topic string")
