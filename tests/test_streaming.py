"""Streaming forms: equal to the batch forms over several batches, in any arrival order, and after a restart."""

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.operators.counting import bucket_counts, windows_over_buckets
from tidecart.plans import active_users, ad_clicks, log_split, order_wide
from tidecart.session import checkpoint_location
from tidecart.sinks import FileTopics
from tidecart.sources import files
from tidecart.streaming import active_users as dau_stream
from tidecart.streaming import ad_clicks as click_stream
from tidecart.streaming import change_capture as cdc_stream
from tidecart.streaming import log_split as log_stream
from tidecart.streaming import order_wide as order_stream

DAY = 1700006400000  # 2023-11-15 00:00:00
AS_OF = "2023-11-20"


class Feed:
    """A folder of text files read as a stream, one file per batch in the order they were added."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0
        os.makedirs(self.folder)

    def add(self, *texts):
        path = f"{self.folder}/{self.n:05d}.txt"
        with open(path, "w") as out:
            out.write("".join(f"{t}\n" for t in texts))
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1

    def stream(self):
        return files.text_stream(self.spark, self.folder, max_files_per_trigger=1)

    def static(self):
        return files.read_text(self.spark, self.folder)


@pytest.fixture
def feed(spark, tmp_path):
    made = []

    def make():
        made.append(Feed(spark, tmp_path / f"in{len(made)}"))
        return made[-1]

    return make


def finish(query):
    query.awaitTermination(300)
    if query.exception():
        raise query.exception()


def run(starter, *args, checkpoint, **options):
    finish(starter(*args, checkpoint=str(checkpoint), available_now=True, **options))


@pytest.fixture
def dims(spark):
    users = spark.createDataFrame([("36", "F", "2000-02-29")], schemas.USER_INFO)
    provinces = spark.createDataFrame([("3", "P", "CN-11", "CN-BJ", "110000")], schemas.BASE_PROVINCE)
    return lambda: (users, provinces)


# --- log split and change capture ------------------------------------------------------------


def test_log_split(spark, feed, tmp_path, rows):
    logs = feed()
    logs.add('{"common":{"mid":"a"},"page":{"page_id":"home"},"displays":[{"item":"1"},{"item":"2"}],"ts":1}', "broken")
    logs.add('{"common":{"mid":"b"},"start":{"entry":"icon"},"ts":2}', '{"err":{"m":1},"page":{}}')
    topics = FileTopics(f"{tmp_path}/topics")
    run(log_stream.start_log_split, logs.stream(), topics, checkpoint=tmp_path / "cp")
    assert rows(topics.read(spark), "topic", "value") == rows(log_split.split(logs.static()))
    assert topics.read(spark).select("batch_id").distinct().count() == 2
    # a restart goes on where the last run stopped
    logs.add('{"common":{"mid":"c"},"page":{"page_id":"home"},"ts":3}')
    run(log_stream.start_log_split, logs.stream(), topics, checkpoint=tmp_path / "cp")
    assert rows(topics.read(spark), "topic", "value") == rows(log_split.split(logs.static()))


def test_change_capture_with_changing_roles(spark, feed, tmp_path, rows):
    event = lambda kind, table, ts, data: json.dumps({"type": kind, "table": table, "ts": ts, "data": data})
    changes = feed()
    changes.add(event("insert", "order_info", 1, {"id": 1}), event("insert", "user_info", 1, {"id": 36, "gender": "F"}))
    changes.add(event("update", "user_info", 9, {"id": 36, "gender": "M"}), event("insert", "order_info", 2, {"id": 2}))
    changes.add(event("update", "user_info", 5, {"id": 36, "gender": "late"}), event("delete", "order_info", 3, {"id": 1}))
    calls = []

    def roles():
        calls.append(1)
        known = [("user_info", "dim")] + ([("order_info", "fact")] if len(calls) > 1 else [])
        return spark.createDataFrame(known, schemas.TABLE_ROLES)

    topics, table = FileTopics(f"{tmp_path}/topics"), cdc_stream.dim_ledger(spark, f"{tmp_path}/dims")
    run(cdc_stream.start_change_capture, changes.stream(), roles, topics, table, checkpoint=tmp_path / "cp", compact_every=1)
    # the fact table was only known from the second batch on
    assert rows(topics.read(spark), "topic", "value") == [("DWD_ORDER_INFO_D", '{"id":1}'), ("DWD_ORDER_INFO_I", '{"id":2}')]
    assert [(r.id, json.loads(r.data)["gender"], r.seq.ts) for r in table.read().collect()] == [("36", "M", 9)]


# --- daily active users ----------------------------------------------------------------------


def page(mid, ts, last=None):
    record = {"mid": mid, "user_id": "36", "province_id": "3", "page_id": "home", "last_page_id": last, "ts": ts}
    return json.dumps({k: v for k, v in record.items() if v is not None})


def test_daily_active(spark, feed, dims, tmp_path, rows):
    pages = feed()
    pages.add(page("a", DAY - 1), page("a", DAY - 2), page("b", DAY - 5, last="home"), *[page("hot", DAY - 9 - i) for i in range(50)])
    pages.add(page("a", DAY - 1000), page("a", DAY), page("b", DAY + 1), *[page("hot", DAY + i) for i in range(50)])
    pages.add(page("a", DAY + 80_000_000), page("c", DAY + 1))
    table = dau_stream.dau_ledger(spark, f"{tmp_path}/dau")
    stream = active_users.parse(pages.stream())
    args = (dau_stream.start_daily_active, stream, dims, table, AS_OF)
    run(*args, checkpoint=tmp_path / "cp", salts=4)
    batch = active_users.daily_active(active_users.parse(pages.static()), *dims(), AS_OF)
    columns = ["dt", "mid", "user_gender", "user_age", "province_name"]
    before = rows(batch, "dt", "mid")
    assert rows(table.read(), *columns) == rows(batch, *columns)
    assert table.read().columns == schemas.DAU_INFO.names
    # restart: known devices stay out, a new one comes in
    pages.add(page("c", DAY + 5), page("d", DAY + 5))
    run(*args, checkpoint=tmp_path / "cp", salts=4)
    assert rows(table.read(), "dt", "mid") == sorted([*before, ("2023-11-15", "d")])
    # nothing was stored twice either
    assert table._log(table._batches()).count() == len(before) + 1


def test_a_landing_dated_in_the_future_closes_no_day(spark, feed, dims, tmp_path, rows):
    pages = feed()
    january = 1_704_672_000_000
    pages.add(page("a", january), page("bad", 4_102_444_800_000))
    for n, mid in enumerate(["b", "c", "d", "a"]):
        pages.add(page(mid, january + 1000 * n - 86_400_000 * (mid == "d")))
    table = dau_stream.dau_ledger(spark, f"{tmp_path}/dau")
    run(dau_stream.start_daily_active, active_users.parse(pages.stream()), dims, table, AS_OF, checkpoint=tmp_path / "cp", salts=2)
    assert rows(table.read(), "mid", "ts") == [
        ("a", january), ("b", january), ("bad", 4_102_444_800_000), ("c", january + 1000), ("d", january + 2000 - 86_400_000)
    ]


def test_the_first_landing_stays_when_its_key_is_forgotten(spark, dims, tmp_path, rows):
    batch = lambda ts: spark.createDataFrame([("a", "2023-11-15", ts)], "mid string, dt string, ts bigint")
    filled = lambda df: df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PAGE_LOG.fields], "dt")
    table = dau_stream.dau_ledger(spark, f"{tmp_path}/dau")
    for n, ts in enumerate((DAY + 5, DAY + 9, DAY + 1)):
        dau_stream.handle_landings(filled(batch(ts)), n, dims, table, AS_OF)
    assert rows(table.read(), "mid", "ts") == [("a", DAY + 5)]
    table.compact(1)
    assert rows(table.read(), "mid", "ts") == [("a", DAY + 5)]


def test_daily_active_without_its_checkpoint_restores_from_the_table(spark, feed, dims, tmp_path, rows):
    pages = feed()
    pages.add(page("a", DAY), page("b", DAY))
    table = dau_stream.dau_ledger(spark, f"{tmp_path}/dau")
    run(dau_stream.start_daily_active, active_users.parse(pages.stream()), dims, table, AS_OF, checkpoint=tmp_path / "cp1")
    first = {r.mid: r.ts for r in table.read().collect()}
    batch = spark.createDataFrame([(m, "2023-11-15", DAY + 99) for m in ("a", "c")], "mid string, dt string, ts bigint")
    filled = [F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PAGE_LOG.fields]
    dau_stream.handle_landings(batch.select(*filled, "dt"), 1, dims, table, AS_OF, restore=True)
    got = {r.mid: r.ts for r in table.read().collect()}
    assert got == {**first, "c": DAY + 99}


# --- orders ----------------------------------------------------------------------------------


def order(id, created):
    return json.dumps({"id": id, "user_id": 36, "province_id": 3, "total_amount": 9.5, "create_time": created})


def detail(id, order_id, created):
    return json.dumps({"id": id, "order_id": order_id, "sku_name": "x", "create_time": created})


def day(n, clock="10:00:00"):
    return f"2023-11-{n:02d} {clock}"


# Two batches of (orders, details). Line ids are ten times the order id plus a number.
ARRIVALS = [
    # 1: same batch, two lines; 2: order first; 3: line first; 4: one line early and one on time; 5: a day apart and a
    # second more; 6: order without lines; 70: line without order
    (
        [order(1, day(1)), order(2, day(1)), order(5, day(1)), order(6, day(1))],
        [detail(10, 1, day(1)), detail(11, 1, day(1)), detail(30, 3, day(1)), detail(40, 4, day(1)), detail(700, 70, day(1))],
    ),
    (
        [order(3, day(1, "12:00:00")), order(4, day(1))],
        [detail(20, 2, day(1, "12:00:00")), detail(41, 4, day(1)), detail(50, 5, day(2)), detail(51, 5, day(2, "10:00:01"))],
    ),
]


def arriving(raw):
    """Raw texts that arrive when they say they were created."""
    return raw.withColumn("timestamp", F.to_timestamp(F.get_json_object("value", "$.create_time")))


BY_ARRIVAL = {"clock": "timestamp", "lateness": "1 hour"}


@pytest.mark.parametrize("salts", [1, 3])
def test_order_wide_in_any_arrival_order(spark, feed, dims, tmp_path, rows, salts):
    orders, details = feed(), feed()
    for some_orders, some_details in ARRIVALS:
        orders.add(*some_orders)
        details.add(*some_details)
    table = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    streams = order_wide.parse_orders(orders.stream()), order_wide.parse_details(details.stream())
    run(order_stream.start_order_wide, *streams, dims, table, AS_OF, checkpoint=tmp_path / "cp", salts=salts, within="24 hours", compact_every=2)
    got = table.read()
    assert rows(got, "detail_id") == [(i,) for i in (10, 11, 20, 30, 40, 41, 50)]
    static = order_wide.parse_orders(orders.static()), order_wide.parse_details(details.static())
    assert rows(got) == rows(order_wide.order_wide(*static, *dims(), AS_OF, within="24 hours"))


def test_a_partner_after_the_wait_is_not_found(spark, feed, dims, tmp_path, rows):
    orders, details = feed(), feed()
    # the second batch moves the watermark, the third one clears order 1 from state
    for some_orders, some_details in [
        ([order(1, day(1))], []),
        ([order(2, day(9))], [detail(20, 2, day(9))]),
        ([order(3, day(9))], []),
        ([], [detail(10, 1, day(1)), detail(21, 2, day(9))]),
    ]:
        orders.add(*some_orders)
        details.add(*some_details)
    table = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    streams = order_wide.parse_orders(arriving(orders.stream())), order_wide.parse_details(arriving(details.stream()))
    run(order_stream.start_order_wide, *streams, dims, table, AS_OF, checkpoint=tmp_path / "cp", salts=2, **BY_ARRIVAL)
    assert rows(table.read(), "detail_id") == [(20,), (21,)]
    assert table.read().columns == schemas.ORDER_WIDE.names


def test_order_wide_restart_finds_the_waiting_side(spark, feed, dims, tmp_path, rows):
    orders, details = feed(), feed()
    table = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    streams = order_wide.parse_orders(orders.stream()), order_wide.parse_details(details.stream())
    args = (order_stream.start_order_wide, *streams, dims, table, AS_OF)
    orders.add(order(1, day(1)))
    details.add(detail(20, 2, day(1)))
    run(*args, checkpoint=tmp_path / "cp", salts=2)
    assert table.read().count() == 0
    orders.add(order(2, day(1)))
    details.add(detail(10, 1, day(1)))
    run(*args, checkpoint=tmp_path / "cp", salts=2)
    assert rows(table.read(), "order_id", "detail_id") == [(1, 10), (2, 20)]


def test_an_order_dated_in_the_future_drops_nothing(spark, feed, dims, tmp_path, rows):
    orders, details = feed(), feed()
    # a three-day backlog, its newest rows first, with one pair dated 2099
    created = [day(3), "2099-01-01 00:00:00", day(1), day(2), day(1)]
    for n, at in enumerate(created):
        orders.add(order(n, at))
        details.add(detail(n * 10, n, at))
    orders.add(order(9, "no time"))
    details.add(detail(90, 9, day(1)), detail(31, 3, day(1)))
    table = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    streams = order_wide.parse_orders(orders.stream()), order_wide.parse_details(details.stream())
    run(order_stream.start_order_wide, *streams, dims, table, AS_OF, checkpoint=tmp_path / "cp", salts=2)
    assert rows(table.read(), "detail_id") == [(i,) for i in (0, 10, 20, 30, 31, 40, 90)]


def test_pairs_handled_twice_give_one_row_per_line(spark, dims, tmp_path, rows):
    orders = spark.createDataFrame([json.loads(order(1, day(1)))], schemas.ORDER_INFO)
    details = spark.createDataFrame([json.loads(detail(10, 1, day(1))), json.loads(detail(11, 1, day(2)))], schemas.ORDER_DETAIL)
    batch = order_stream.paired(orders, details, salts=2)
    table = order_stream.wide_ledger(spark, f"{tmp_path}/wide")
    for batch_id in (0, 0, 1):
        order_stream.handle_pairs(batch, batch_id, dims, table, AS_OF)
    assert rows(table.read(), "detail_id") == [(10,), (11,)]


def test_unmatched_rows_come_out_of_the_audit_streams(spark, feed, tmp_path, rows):
    orders, details = feed(), feed()
    orders.add(order(1, day(1)), order(2, day(1)))
    details.add(detail(10, 1, day(1)), detail(30, 3, day(1)))
    for n in (9, 20, 28):  # later rows move the watermark past the wait
        orders.add(order(100 + n, day(n)))
        details.add(detail(100 + n, 100 + n, day(n)))
    streams = order_wide.parse_orders(arriving(orders.stream())), order_wide.parse_details(arriving(details.stream()))
    topics = FileTopics(f"{tmp_path}/late")
    options = {"salts": 2, "available_now": True, **BY_ARRIVAL}
    for query in order_stream.start_order_late(*streams, lambda: FileTopics(topics.path), str(tmp_path), **options):
        finish(query)
    letters = [json.loads(r.value) for r in topics.read(spark, order_wide.LATE_TOPIC).collect()]
    assert sorted((r["reason"], json.loads(r["value"])["id"]) for r in letters) == [("no line came", 2), ("no order came", 30)]


# --- clicks ----------------------------------------------------------------------------------


def click(ms, user="1", ad="2"):
    return f"{ms} East Boston {user} {ad}"


def test_click_counters(spark, feed, tmp_path, rows):
    clicks = feed()
    clicks.add(*[click(DAY + i, "a") for i in range(3)], click(DAY, "b"), "broken")
    clicks.add(*[click(DAY + i, "a") for i in range(2)], click(DAY, "b"))
    clicks.add(click(DAY, "b"), click(DAY, "c", "9"))
    counts = click_stream.user_ad_ledger(spark, f"{tmp_path}/counts")
    banned = click_stream.black_list_ledger(spark, f"{tmp_path}/banned")
    areas = click_stream.area_city_ledger(spark, f"{tmp_path}/areas")
    run(click_stream.start_black_list, clicks.stream(), counts, banned, threshold=2, compact_every=2, checkpoint=tmp_path / "cp1")
    run(click_stream.start_area_city_counts, clicks.stream(), areas, compact_every=2, checkpoint=tmp_path / "cp2")
    assert rows(counts.read()) == [("2023-11-15", "b", "2", 3), ("2023-11-15", "c", "9", 1)]
    assert rows(banned.read()) == [("a",), ("b",)]
    assert rows(areas.read()) == rows(ad_clicks.area_city_counts(ad_clicks.parse(clicks.static())))


def test_click_trend_closed_windows_equal_batch(spark, feed, tmp_path, rows):
    clicks = feed()
    times = [0, 500, 9_999, 10_000, 25_000, 61_000, 62_000, 130_000]
    for start_at in range(0, len(times), 2):
        clicks.add(*[click(DAY + t) for t in times[start_at : start_at + 2]])
    query = click_stream.start_click_trend(
        clicked(clicks.stream()), "memory", f"{tmp_path}/cp", "trend", mode="append", available_now=True, clock="timestamp"
    )
    finish(query)
    got = rows(spark.table("trend"))
    want = rows(ad_clicks.click_trend(ad_clicks.parse(clicks.static())).where(F.col("window_end_ms") <= DAY + 120_000))
    assert got == want and len(got) == 4 * 6


def clicked(raw):
    """Raw clicks that arrive when they say they were made."""
    return raw.withColumn("timestamp", F.timestamp_millis(F.split("value", " ")[0].cast("bigint")))


def test_clicks_count_when_they_arrive(spark, feed, tmp_path):
    """A click of the year 2100, then a backlog of three days, newest first: nothing is dropped."""
    clicks = feed()
    clicks.add(click(4_102_444_800_000))
    for days in (0, 1, 2, 3):
        clicks.add(click(DAY - days * 86_400_000), click(DAY - days * 86_400_000 + 1))
    finish(click_stream.start_click_trend(clicks.stream(), "memory", f"{tmp_path}/cp", "late_trend", available_now=True))
    newest = spark.table("late_trend").groupBy("window_start_ms", "bucket_ms").agg(F.max("count").alias("n"))
    per_bucket = newest.groupBy("bucket_ms").agg(F.min("n"), F.max("n"), F.count(F.lit(1))).orderBy("bucket_ms").collect()
    assert [tuple(r) for r in per_bucket] == [(DAY - d * 86_400_000, 2, 2, 6) for d in (3, 2, 1, 0)] + [(4_102_444_800_000, 1, 1, 6)]


def test_click_trend_equals_counting_every_window_directly(spark, rows):
    clicks = spark.createDataFrame([(str(DAY + i * i * 37),) for i in range(200)], "ts string")
    timed = ad_clicks.with_event_time(clicks).withColumn("bucket_ms", F.floor(F.col("ts").cast("bigint") / 10_000) * 10_000)
    direct = timed.groupBy(F.window("event_time", "60 seconds", "10 seconds").alias("w"), "bucket_ms").count()
    direct = direct.select(F.unix_millis("w.start"), F.unix_millis("w.end"), "bucket_ms", "count")
    assert rows(windows_over_buckets(bucket_counts(timed, "event_time"))) == rows(direct)


def test_checkpoint_folder_comes_from_the_cluster():
    with pytest.raises(ValueError):
        checkpoint_location(SimpleNamespace(conf={}), "q")
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/cp/"})
    assert checkpoint_location(cluster, "q") == "/shared/cp/q"


# --- dimensions ------------------------------------------------------------------------------


def test_a_small_batch_reads_the_dimension_rows_it_refers_to(spark, tmp_path, rows):
    """Fifty pairs against 200,000 users, a few of which changed since the last compaction."""
    import time

    dims = cdc_stream.dim_ledger(spark, f"{tmp_path}/dims")
    seq = lambda n: F.struct(*[F.lit(n).cast("bigint").alias(k) for k in ("ts", "xid", "xoffset", "arrived")]).alias("seq")
    user = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday")))
    of = lambda df, table, data, n=1: df.select(F.lit(table).alias("table_name"), F.col("id").cast("string").alias("id"), data.alias("data"), F.lit("I").alias("op"), seq(n))
    province = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit("P").alias("name")))
    dims.write(of(spark.range(200_000), "USER_INFO", user).unionByName(of(spark.range(5), "BASE_PROVINCE", province)), 0)
    dims.compact(0)
    male = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit("M").alias("gender"), F.lit("2000-01-01").alias("birthday")))
    dims.write(of(spark.range(10), "USER_INFO", male, 2).unionByName(of(spark.range(7, 8), "USER_INFO", user, 0)), 1)
    orders = spark.createDataFrame([json.loads(order(n, day(1))) | {"user_id": n, "province_id": n % 7} for n in range(50)], schemas.ORDER_INFO)
    details = spark.createDataFrame([json.loads(detail(n, n, day(1))) for n in range(50)], schemas.ORDER_DETAIL)
    near = cdc_stream.CurrentDims(dims)
    tables = [order_stream.wide_ledger(spark, f"{tmp_path}/{n}") for n in range(3)]
    batch = order_stream.paired(orders, details, salts=2)
    for table in tables:
        table.bind("run")
    order_stream.handle_pairs(batch, 0, near, tables[0], AS_OF)  # warm
    spark.sparkContext.setJobGroup("near", "near")
    began = time.time()
    order_stream.handle_pairs(batch, 0, near, tables[1], AS_OF)
    took = time.time() - began
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("near"))
    spark.sparkContext.setJobGroup("", "")
    order_stream.handle_pairs(batch, 0, lambda: near(), tables[2], AS_OF)
    assert rows(tables[1].read()) == rows(tables[2].read())
    got = {r["detail_id"]: (r["user_gender"], r["province_name"]) for r in tables[1].read().collect()}
    assert got[3] == ("M", "P") and got[20] == ("F", None) and got[7] == ("M", "P") and len(got) == 50
    print("jobs", jobs, "seconds", round(took, 2))
    assert jobs <= 20 and took < 15
