import json
from collections import Counter

from tidecart.plans import active_users, log_split

COMMON = {"ar": "3", "uid": "36", "os": "android", "ch": "xiaomi", "is_new": "0", "md": "Xiaomi 9", "mid": "mid_73", "vc": "v2.1.134", "ba": "Xiaomi"}
PAGE = {"page_id": "good_detail", "item": "7", "item_type": "sku_id", "during_time": 12000, "last_page_id": "home", "source_type": "query"}
DISPLAY = {"display_type": "promotion", "item": "2", "item_type": "sku_id", "pos_id": "4", "order": "1"}
ACTION = {"action_id": "cart_add", "item": "7", "item_type": "sku_id", "ts": 1700000005000}
START = {"entry": "icon", "open_ad_id": "5", "loading_time": 3000, "open_ad_ms": 1500, "open_ad_skip_ms": 0}
TS = 1700000000000


def raw(spark, *messages):
    texts = [m if m is None or isinstance(m, str) else json.dumps(m) for m in messages]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def device(n):
    return {**COMMON, "mid": f"m{n}"}


# Message, then the expected numbers of page, display, action and start records.
GOOD = [
    ({"page": PAGE, "displays": [DISPLAY], "actions": [ACTION], "ts": TS}, (1, 1, 1, 0)),
    ({"start": START, "ts": TS}, (0, 0, 0, 1)),
    ({"page": PAGE, "start": START, "displays": [DISPLAY] * 2, "ts": TS}, (1, 2, 0, 1)),
    ({"page": PAGE, "err": None, "ts": TS}, (1, 0, 0, 0)),
    ({"page": PAGE, "displays": [], "actions": [], "ts": TS}, (1, 0, 0, 0)),
    ({"page": PAGE, "displays": [DISPLAY, None], "actions": [None], "ts": TS}, (1, 1, 0, 0)),
    ({"displays": [DISPLAY], "actions": [ACTION], "ts": TS}, (0, 0, 0, 0)),
    ({"page": {}}, (1, 0, 0, 0)),
    ({}, (0, 0, 0, 0)),
]
# Whole messages that only go to the error topic.
ERRORS = [{"common": COMMON, "err": {"msg": "x"}, "page": PAGE, "displays": [DISPLAY], "start": START, "ts": TS}, {"err": {}}]
# Texts that only go to the dead letters.
DEAD = ["not json", "", None, "[1]", '{"page": "a text"}']


def test_outputs_per_message(spark):
    good = [{"common": device(n), **message} for n, (message, _) in enumerate(GOOD)]
    source = raw(spark, *good, *ERRORS, *DEAD)
    sent = [(r.topic, r.value) for r in log_split.split(source).collect()]
    topics = (log_split.PAGE_TOPIC, log_split.DISPLAY_TOPIC, log_split.ACTION_TOPIC, log_split.START_TOPIC)
    records = Counter((topic, json.loads(value)["mid"]) for topic, value in sent if topic in topics)
    for n, (message, expected) in enumerate(GOOD):
        assert tuple(records[topic, f"m{n}"] for topic in topics) == expected, message
    assert [v for topic, v in sent if topic == log_split.ERROR_TOPIC] == [json.dumps(m) for m in ERRORS]
    assert [v for topic, v in sent if topic == log_split.DEAD_LETTER_TOPIC] == DEAD
    # the typed outputs hold the same records
    parsed = log_split.parse(source)
    outputs = (log_split.page_logs, log_split.display_logs, log_split.action_logs, log_split.start_logs)
    for topic, output in zip(topics, outputs):
        assert Counter(r.mid for r in output(parsed).collect()) == {m: c for (t, m), c in records.items() if t == topic}
    assert [r.value for r in log_split.error_logs(parsed).collect()] == [json.dumps(m) for m in ERRORS]
    assert [r.value for r in log_split.dead_letters(parsed).collect()] == DEAD


def test_page_fields(spark):
    page = log_split.page_logs(log_split.parse(raw(spark, {"common": COMMON, "page": PAGE, "ts": TS}))).first()
    assert page.asDict() == {
        "mid": "mid_73", "user_id": "36", "province_id": "3", "channel": "xiaomi", "is_new": "0", "model": "Xiaomi 9",
        "operate_system": "android", "version_code": "v2.1.134", "brand": "Xiaomi", "page_id": "good_detail",
        "last_page_id": "home", "page_item": "7", "page_item_type": "sku_id", "during_time": 12000, "sourceType": "query",
        "ts": TS,
    }


def test_display_action_and_start_fields(spark):
    parsed = log_split.parse(
        raw(spark, {"common": COMMON, "page": PAGE, "start": START, "displays": [DISPLAY], "actions": [ACTION], "ts": TS})
    )
    display, action, start = (f(parsed).first() for f in (log_split.display_logs, log_split.action_logs, log_split.start_logs))
    assert (display.display_type, display.display_item, display.display_item_type) == ("promotion", "2", "sku_id")
    assert (display.display_order, display.display_pos_id, display.ts, len(display)) == ("1", "4", TS, 21)
    assert (action.action_id, action.action_item, action.action_item_type) == ("cart_add", "7", "sku_id")
    assert (action.action_ts, action.ts, len(action)) == (1700000005000, TS, 20)
    assert (start.entry, start.open_ad_id, start.loading_time_ms, start.open_ad_ms, start.open_ad_skip_ms) == ("icon", "5", 3000, 1500, 0)
    assert len(start) == 15


def test_numbers_as_text_and_missing_numbers(spark):
    page = {**PAGE, "during_time": "12"}
    del PAGE["item"]
    first, second = log_split.page_logs(
        log_split.parse(raw(spark, {"common": COMMON, "page": page, "ts": str(TS)}, {"page": {"page_id": "home", "during_time": "x"}}))
    ).collect()
    PAGE["item"] = "7"
    assert (first.during_time, first.ts) == (12, TS)
    assert (second.during_time, second.ts, second.mid) == (None, None, None)


def test_messages_are_json_without_nulls(spark):
    sent = {r.topic: r.value for r in log_split.split(raw(spark, {"common": {"mid": "m"}, "page": {"page_id": "home"}, "ts": 1})).collect()}
    assert json.loads(sent[log_split.PAGE_TOPIC]) == {"mid": "m", "page_id": "home", "ts": 1}


def test_error_message_passes_whole(spark):
    text = '{"err":{"msg":"x","code":1.50}, "extra":[1]}'
    sent = log_split.split(raw(spark, text)).collect()
    assert [(r.topic, r.value) for r in sent] == [(log_split.ERROR_TOPIC, text)]


def test_page_topic_reads_back(spark, rows):
    source = raw(spark, {"common": COMMON, "page": PAGE, "ts": TS}, {"common": {"mid": "m"}, "page": {}, "ts": 5})
    messages = log_split.split(source).where(f"topic = '{log_split.PAGE_TOPIC}'")
    assert rows(active_users.parse(messages)) == rows(log_split.page_logs(log_split.parse(source)))


def test_each_text_is_parsed_once(spark):
    plan = log_split.page_logs(log_split.parse(raw(spark, "{}")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
