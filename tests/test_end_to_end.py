"""Change events and logs in, serving answers out: every stage reads what the stage before it stored."""

import json

from test_streaming import AS_OF, DAY, Feed, finish

from tidecart import schemas
from tidecart.plans import active_users, log_split, order_wide, serving
from tidecart.sinks import FileTopics
from tidecart.sources import files
from tidecart.streaming import active_users as dau_stream
from tidecart.streaming import change_capture as cdc_stream
from tidecart.streaming import log_split as log_stream
from tidecart.streaming import order_wide as order_stream


def change(table, ts, data, kind="insert"):
    return json.dumps({"type": kind, "table": table, "ts": ts, "data": data})


def topic_stream(topics, spark, topic):
    """A topic written by an earlier stage as a stream."""
    rows = files.parquet_stream(spark, topics.path, schemas.TOPIC_ROWS, max_files_per_trigger=1)
    return rows.where(f"topic = '{topic}'").select("value")


def test_from_raw_messages_to_serving_answers(spark, tmp_path, rows):
    changes, logs = Feed(spark, tmp_path / "changes"), Feed(spark, tmp_path / "logs")
    changes.add(
        change("user_info", 1, {"id": 36, "gender": "F", "birthday": "2000-02-29"}, "bootstrap-insert"),
        change("user_info", 1, {"id": 37, "gender": "F", "birthday": "1980-01-01"}),
        change("base_province", 1, {"id": 3, "name": "P", "iso_code": "CN-11", "iso_3166_2": "CN-BJ", "area_code": "110000"}),
        change("order_detail", 2, {"id": 10, "order_id": 1, "sku_name": "Red Widget", "sku_num": 2, "order_price": 5.0,
                                   "split_total_amount": 10.0, "create_time": "2023-11-15 10:00:00"}),
    )
    changes.add(
        change("user_info", 3, {"id": 37, "gender": "M", "birthday": "1980-01-01"}, "update"),
        change("order_info", 3, {"id": 1, "user_id": 36, "province_id": 3, "total_amount": 30.5, "create_time": "2023-11-15 10:00:05"}),
        change("order_info", 3, {"id": 2, "user_id": 37, "province_id": 3, "total_amount": 7.0, "create_time": "2023-11-15 11:00:00"}),
        change("order_detail", 3, {"id": 20, "order_id": 2, "sku_name": "red widget XL", "split_total_amount": 7.0, "create_time": "2023-11-15 11:00:01"}),
        change("order_detail", 3, {"id": 11, "order_id": 1, "sku_name": "Blue Gear", "split_total_amount": 20.5, "create_time": "2023-11-15 10:00:06"}),
    )
    landing = lambda mid, ts: json.dumps({"common": {"mid": mid, "uid": "36", "ar": "3"}, "page": {"page_id": "home"}, "ts": ts})
    hour = 3_600_000
    logs.add(landing("a", DAY + hour), landing("b", DAY + hour), landing("c", DAY + 5 * hour))
    logs.add(landing("a", DAY + 2 * hour), landing("d", DAY - 1), json.dumps({"err": {"msg": "x"}}))

    roles = [("order_info", "fact"), ("order_detail", "fact"), ("user_info", "dim"), ("base_province", "dim")]
    topics, dims = FileTopics(f"{tmp_path}/topics"), cdc_stream.dim_ledger(spark, f"{tmp_path}/dims")
    options = {"available_now": True}
    finish(
        cdc_stream.start_change_capture(
            changes.stream(), lambda: spark.createDataFrame(roles, schemas.TABLE_ROLES), topics, dims,
            checkpoint=f"{tmp_path}/cp_cdc", **options,
        )
    )
    log_topics = FileTopics(f"{tmp_path}/log_topics")
    finish(log_stream.start_log_split(logs.stream(), log_topics, checkpoint=f"{tmp_path}/cp_log", **options))

    current = lambda: cdc_stream.current_dims(dims)
    wide = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    finish(
        order_stream.start_order_wide(
            order_wide.parse_orders(topic_stream(topics, spark, "DWD_ORDER_INFO_I")),
            order_wide.parse_details(topic_stream(topics, spark, "DWD_ORDER_DETAIL_I")),
            current, wide, AS_OF, checkpoint=f"{tmp_path}/cp_wide", **options,
        )
    )
    dau = dau_stream.dau_ledger(spark, f"{tmp_path}/dau")
    pages = active_users.parse(topic_stream(log_topics, spark, log_split.PAGE_TOPIC))
    finish(dau_stream.start_daily_active(pages, current, dau, AS_OF, checkpoint=f"{tmp_path}/cp_dau", **options))

    day = wide.read(where="create_date = '2023-11-15'")
    assert rows(serving.stats_by_item(day, "red widget", "2023-11-15", "gender")) == [("女", 10.0), ("男", 7.0)]
    assert rows(serving.stats_by_item(day, "widget", "2023-11-15", "age")) == [("20到29岁", 10.0), ("20岁以下", 0.0), ("30岁以上", 7.0)]
    found = serving.detail_by_item(day, "2023-11-15", "red widget", 1, 1)
    assert found.total.first().total == 2
    assert tuple(found.detail.select("sku_name", "province_name", "user_age").first()) == ("<em>red</em> <em>widget</em> XL", "P", 43)
    assert rows(serving.dau_realtime(dau.read(), "2023-11-15")) == [("dauTd", "01", 2), ("dauTd", "05", 1), ("dauTotal", None, 3), ("dauYd", "23", 1)]
