"""Every input row takes one route, in batches and in streams, and the routes add up to the input."""

import json

import pytest
from pyspark.sql import functions as F
from test_streaming import DAY, click, detail, feed, finish, order  # noqa: F401

from tidecart import schemas
from tidecart.operators import routing
from tidecart.operators.parsing import routed_records, typed_records
from tidecart.plans import active_users, ad_clicks, change_capture, log_split, order_wide
from tidecart.sinks import FileTopics
from tidecart.streaming import ad_clicks as click_stream
from tidecart.streaming import change_capture as cdc_stream
from tidecart.streaming.run import start_dead_letters


@pytest.fixture
def texts(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def adds_up(row):
    assert row["rows"] == sum(row[r] for r in routing.ROUTES)
    return tuple(row[r] for r in routing.ROUTES)


def routes(df):
    return sorted((r["value"], r["route"], r["reason"]) for r in df.select("value", "route", "reason").collect())


def test_first_reason_decides(spark):
    rows = spark.createDataFrame([(n, n % 2 == 0, n % 3 == 0) for n in range(1, 7)], "n int, two boolean, three boolean")
    why = lambda **cases: routing.reasons(**cases)
    tagged = routing.routed(rows, dead=why(by_two=F.col("two")), other=why(by_three=F.col("three"), six=F.col("n") == 6))
    assert [(r["n"], r["route"], r["reason"]) for r in tagged.orderBy("n").collect()] == [
        (1, "stored", None), (2, "dead", "by two"), (3, "other", "by three"), (4, "dead", "by two"), (5, "stored", None), (6, "dead", "by two")
    ]
    assert adds_up(routing.accounts(tagged).first()) == (2, 0, 3, 1)
    assert {r["two"]: adds_up(r) for r in routing.accounts(tagged, "two").collect()} == {True: (0, 0, 3, 0), False: (2, 0, 0, 1)}
    assert adds_up(routing.accounts(tagged.limit(0)).first()) == (0, 0, 0, 0)


def test_records_without_a_required_field(spark, texts):
    raw = texts('{"id":"7","v":1}', '{"id":"x"}', '{"v":2}', "[1]", "", None, "not json")
    schema = schemas._ddl("id bigint, v string")
    found = routes(routed_records(raw.where("value is not null"), schema, ["id"]))
    assert [(v, r, w) for v, r, w in found] == sorted(
        [('{"id":"7","v":1}', "stored", None), ('{"id":"x"}', "dead", "no id"), ('{"v":2}', "dead", "no id")]
        + [(v, "dead", "not a JSON object") for v in ("[1]", "", "not json")]
    )
    # what is read as records is what is not dead for its shape
    assert typed_records(raw, schema).count() == 3


def test_log_routes(texts):
    page, start = '{"page":{"page_id":"h"},"common":{}}', '{"start":{"entry":"i"}}'
    raw = texts(page, start, '{"err":{"m":1}}', '{"common":{}}', "broken")
    tagged = log_split.routed(raw)
    assert adds_up(routing.accounts(tagged).first()) == (3, 0, 1, 1)
    # every stored message is in a topic, no other one is
    topics = {r["topic"] for r in log_split.split(raw.where(F.col("value").isin(page, start))).collect()}
    assert topics == {log_split.PAGE_TOPIC, log_split.START_TOPIC}
    assert {r["topic"] for r in log_split.split(texts('{"common":{}}', "broken")).collect()} == {log_split.DEAD_LETTER_TOPIC}


def event(kind, table, data, ts=1):
    return json.dumps({"type": kind, "table": table, "ts": ts, "data": data})


ROLES = [("order_info", "fact"), ("base_province", "fact"), ("base_province", "dim"), ("user_info", "dim")]
CHANGES = [
    event("insert", "order_info", {"id": 1}),
    event("insert", "base_province", {"id": 3}),
    event("update", "user_info", {"gender": "F"}),
    event("bootstrap-start", "user_info", {}),
    event("insert", "sku_info", {"id": 2}),
    "no event",
    "[]",
]


def test_change_routes_and_dead_letters(spark, feed, texts, tmp_path, rows):  # noqa: F811
    roles = spark.createDataFrame(ROLES, schemas.TABLE_ROLES)
    tagged = change_capture.routed(texts(*CHANGES), roles)
    assert adds_up(routing.accounts(tagged).first()) == (2, 0, 3, 2)
    assert tagged.count() == len(CHANGES)  # a table in two roles is still one row
    changes = feed()
    changes.add(*CHANGES[:4])
    changes.add(*CHANGES[4:])
    topics, table = FileTopics(f"{tmp_path}/topics"), cdc_stream.dim_ledger(spark, f"{tmp_path}/dims")
    finish(cdc_stream.start_change_capture(changes.stream(), lambda: roles, topics, table, checkpoint=f"{tmp_path}/cp", available_now=True))
    dead = topics.read(spark, change_capture.DEAD_LETTER_TOPIC).collect()
    assert sorted(json.loads(r["value"])["reason"] for r in dead) == ["no id", "not a change event", "not a change event"]
    assert rows(topics.read(spark).where(F.col("topic") != change_capture.DEAD_LETTER_TOPIC), "topic") == [
        ("DWD_BASE_PROVINCE_I",), ("DWD_ORDER_INFO_I",)
    ]
    assert rows(table.read(), "table_name", "id") == [("BASE_PROVINCE", "3")]


def test_page_routes(texts):
    page = lambda **more: json.dumps({"mid": "a", "page_id": "home", "ts": 1} | more)
    tagged = active_users.routed(texts(page(), page(last_page_id="x"), page(ts="no"), "broken", '{"ts":1}'))
    assert adds_up(routing.accounts(tagged).first()) == (1, 0, 3, 1)


def test_line_routes(spark, texts):
    at = "2023-11-01 10:00:00"
    orders = order_wide.parse_orders(texts(order(1, at), order(2, at)))
    lines = texts(detail(10, 1, at), detail(20, 2, "2023-11-03 10:00:00"), detail(30, 3, at), '{"id":4}', "broken")
    tagged = order_wide.routed_details(lines, orders)
    assert adds_up(routing.accounts(tagged).first()) == (1, 2, 2, 0)
    late = {r["id"]: r["reason"] for r in tagged.where("route = 'late'").collect()}
    assert late == {20: "order too far in time", 30: "no order"}


def test_click_stream_accounts_and_dead_letters(spark, feed, tmp_path):  # noqa: F811
    clicks = feed()
    clicks.add(click(DAY), "short line", click("x12"), click(DAY, "b"))
    clicks.add(click(DAY, "c"))
    topics, counts = FileTopics(f"{tmp_path}/topics"), click_stream.area_city_ledger(spark, f"{tmp_path}/areas")
    query = click_stream.start_area_city_counts(clicks.stream(), counts, topics=topics, checkpoint=f"{tmp_path}/cp", available_now=True)
    finish(query)
    assert [adds_up(a) for a in routing.accounts_of(query).values()] == [(2, 0, 2, 0), (1, 0, 0, 0)]
    dead = topics.read(spark, ad_clicks.DEAD_LETTER_TOPIC).collect()
    assert sorted(json.loads(r["value"])["reason"] for r in dead) == ["missing fields", "time is no number"]
    assert sum(r["count"] for r in counts.read().collect()) == 3


def test_dead_letters_of_a_step_with_state(spark, feed, tmp_path):  # noqa: F811
    orders = feed()
    orders.add(order(1, "2023-11-01 10:00:00"), "broken", '{"user_id":1}')
    topics = FileTopics(f"{tmp_path}/topics")
    query = start_dead_letters(
        orders.stream(), order_wide.routed_orders, order_wide.DEAD_LETTER_TOPIC, topics, checkpoint=f"{tmp_path}/cp", available_now=True
    )
    finish(query)
    assert [adds_up(a) for a in routing.accounts_of(query).values()] == [(1, 0, 2, 0)]
    dead = topics.read(spark, order_wide.DEAD_LETTER_TOPIC).collect()
    assert sorted(json.loads(r["value"])["reason"] for r in dead) == ["no id", "not a JSON object"]
