import json

import pytest

from tidecart.plans import change_capture, dimensions

ROLES = [("order_info", "fact"), ("user_info", "dim"), ("base_province", "dim"), ("both", "fact"), ("both", "dim")]


def event(kind, table, data, ts=1700000000, **more):
    return json.dumps({"type": kind, "table": table, "ts": ts, "data": data, **more})


@pytest.fixture
def route(spark):
    roles = spark.createDataFrame(ROLES, "table_name string, role string")

    def run(*texts):
        changes = change_capture.parse(spark.createDataFrame([(t,) for t in texts], "value string"))
        return change_capture.fact_messages(changes, roles), change_capture.dim_changes(changes, roles)

    return run


@pytest.mark.parametrize("kind, op", [("insert", "I"), ("bootstrap-insert", "I"), ("update", "U"), ("delete", "D")])
def test_fact_topic(route, kind, op):
    facts, dims = route(event(kind, "order_info", {"id": 101, "total_amount": 99.5, "note": None}))
    sent = facts.collect()
    assert [r.topic for r in sent] == [f"DWD_ORDER_INFO_{op}"]
    assert json.loads(sent[0].value) == {"id": 101, "total_amount": 99.5, "note": None}
    assert dims.count() == 0


@pytest.mark.parametrize("kind", ["bootstrap-start", "bootstrap-complete", "table-create", None])
def test_other_events_are_dropped(route, kind):
    facts, dims = route(event(kind, "order_info", {"id": 1}), event(kind, "user_info", {"id": 1}))
    assert facts.count() == dims.count() == 0


def test_tables_in_both_roles_or_none(route):
    facts, dims = route(event("insert", "both", {"id": 1}), event("insert", "unknown", {"id": 1}))
    assert [r.topic for r in facts.collect()] == ["DWD_BOTH_I"]
    assert [(r.table_name, r.id) for r in dims.collect()] == [("BOTH", "1")]


def test_latest_dimension_row(route, rows):
    _, dims = route(
        event("update", "user_info", {"id": 36, "gender": "M"}, ts=3),
        event("insert", "user_info", {"id": 36, "gender": "F"}, ts=1),
        event("update", "user_info", {"id": 37, "gender": "A"}, ts=5, xoffset=0),
        event("update", "user_info", {"id": 37, "gender": "B"}, ts=5, xoffset=1),
        event("insert", "user_info", {"id": 38}, ts=1),
        event("delete", "user_info", {"id": 38, "gender": "F"}, ts=2),
    )
    latest = change_capture.latest_dims(dims)
    got = {r.id: (r.op, json.loads(r.data).get("gender")) for r in latest.collect()}
    # a delete keeps the row it carries
    assert got == {"36": ("U", "M"), "37": ("U", "B"), "38": ("D", "F")}
    assert {r.id for r in change_capture.latest_dims(dims, drop_deleted=True).collect()} == {"36", "37"}
    assert rows(dimensions.user_table(latest), "id", "gender") == [("36", "M"), ("37", "B"), ("38", "F")]


def test_order_within_a_second(route):
    _, dims = route(
        event("update", "user_info", {"id": 1, "gender": "OLD"}, ts=100, xid=1, xoffset=5),
        event("update", "user_info", {"id": 1, "gender": "NEW"}, ts=100, xid=2, xoffset=0),
        event("update", "user_info", {"id": 2, "gender": "a"}, ts=100, xid=3, xoffset=0),
        event("update", "user_info", {"id": 2, "gender": "c"}, ts=100, xid=3),
        event("update", "user_info", {"id": 2, "gender": "b"}, ts=100, xid=3, xoffset=1),
    )
    got = {r.id: json.loads(r.data)["gender"] for r in change_capture.latest_dims(dims).collect()}
    assert got == {"1": "NEW", "2": "c"}


def test_source_offset_decides_last(spark):
    texts = [(event("update", "user_info", {"id": 1, "gender": g}, ts=1), n) for g, n in (("new", 8), ("old", 7))]
    changes = change_capture.parse(spark.createDataFrame(texts, "value string, offset long"))
    roles = spark.createDataFrame(ROLES, "table_name string, role string")
    latest = change_capture.latest_dims(change_capture.dim_changes(changes, roles)).collect()
    assert [json.loads(r.data)["gender"] for r in latest] == ["new"]


def test_typed_dimensions(route):
    _, dims = route(
        event("insert", "base_province", {"id": 3, "name": "P", "iso_code": "CN-11", "iso_3166_2": "CN-BJ", "area_code": "110000"}),
        event("bootstrap-insert", "user_info", {"id": 36, "gender": "F", "birthday": "2000-02-29"}),
    )
    assert tuple(dimensions.province_table(dims).first()) == ("3", "P", "CN-11", "CN-BJ", "110000")
    assert tuple(dimensions.user_table(dims).first()) == ("36", "F", "2000-02-29")


def test_broken_events(spark, route):
    raw = spark.createDataFrame([("nope",), (None,), (event("insert", "order_info", {"id": 1}),)], "value string")
    assert change_capture.dead_letters(raw).count() == 2
    assert route("nope", None)[0].count() == 0
