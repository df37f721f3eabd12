"""One batch query per operator or serving question, over the source tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.demo import tables as t
from tidecart import schemas
from tidecart.functions import times
from tidecart.operators import routing
from tidecart.operators.counting import count_by, sum_by
from tidecart.operators.paging import page_after, seek_page, top_groups
from tidecart.plans import active_users, ad_clicks, change_capture, log_split, order_wide, serving
from tidecart.session import shared_folder
from tidecart.sinks import CounterLedger, DayIndex, FirstLedger, KeyedLedger, SetLedger
from tidecart.streaming import active_users as dau_stream
from tidecart.streaming import ad_clicks as click_stream

Query = Callable[[SparkSession, str], DataFrame]

# Request parameters of the serving queries.
ORDER_DAY = "1997-02-01"
ITEM = "Widget"
DAU_DAY = "2024-01-15"
PAGE_NO, PAGE_SIZE = 2, 3
DEEP_PAGE, DEEP_SIZE = 123, 20
# Clicks per user, advertisement and day are few in the source tables.
CLICK_THRESHOLD = 2


def _wide(spark: SparkSession, folder: str, day: str | None = None, **options) -> DataFrame:
    orders = t.orders(spark, folder, day)
    return order_wide.order_wide(
        orders,
        t.details(spark, folder, None if day is None else orders),
        t.users(spark, folder),
        t.provinces(spark, folder),
        t.AS_OF,
        bare_details=t.source(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id")),
        **options,
    )


_BUILT: dict[tuple[str, str], DayIndex] = {}


def order_index(spark: SparkSession, folder: str) -> DayIndex:
    """The wide order lines of the day asked for and those beside it, stored and indexed: built once in a session, then read by
    every query for that day."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        wide = _wide(spark, folder, ORDER_DAY)
        index = DayIndex(spark, _fresh(spark), wide.schema, "create_date", "detail_id", "sku_name")
        index.write(wide, 0)
        index.compact(0)
        _BUILT[key] = index
    return _BUILT[key]


def _stats(by: str, day: str | None, item: str = ITEM) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _wide(spark, folder) if day is None else order_index(spark, folder).search(item, day)
        stats = serving.stats_by_item(rows, item, day, by)
        return stats.withColumn("value", F.round("value", 2))

    return query


def _detail(part: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = order_index(spark, folder).search(ITEM, ORDER_DAY)
        return getattr(serving.detail_by_item(found, ORDER_DAY, ITEM, PAGE_NO, PAGE_SIZE), part)

    return query


def _deep_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page out of the middle of all wide lines, stored and then sought by counting ranges."""
    at = f"{_fresh(spark)}/lines"
    _wide(spark, folder).select("detail_id", "create_time", "sku_name", "total_amount").write.parquet(at)
    return seek_page(spark.read.parquet(at), serving.DETAIL_ORDER, DEEP_PAGE, DEEP_SIZE, most=1000)


def _next_page(spark: SparkSession, folder: str) -> DataFrame:
    """The page after a given line."""
    wide = _wide(spark, folder).select("detail_id", "create_time", "sku_name", "total_amount")
    return page_after(wide, serving.DETAIL_ORDER, ["1995-06-01 00:00:00", ""], DEEP_SIZE)


def _top_ages(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_by(_wide(spark, folder).where(F.col("user_age").isNotNull()), ["user_age"], "n")
    return top_groups(counts, "n", "user_age", 24)


def _dau(spark: SparkSession, folder: str) -> DataFrame:
    pages = log_split.page_logs(log_split.parse(t.raw_logs(spark, folder)))
    return active_users.daily_active(pages, t.users(spark, folder), t.provinces(spark, folder), t.AS_OF)


def _dau_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The day table with the columns the hourly queries need: no dimension takes part."""
    pages = log_split.page_logs(log_split.parse(t.raw_logs(spark, folder)))
    first = active_users.first_landings(active_users.landings(pages).select("dt", "mid", "ts"))
    return first.withColumn("hr", times.hour_of_ms(F.col("ts")))


_DAYS: dict[tuple[str, str], FirstLedger] = {}


def dau_table(spark: SparkSession, folder: str) -> FirstLedger:
    """The day records as the stream stores them: pages of hours 0-7, 8-15 and 16-23 come as three batches, the second one twice.
    Built once in a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _DAYS:
        at = _fresh(spark)
        pages = log_split.page_logs(log_split.parse(t.raw_logs(spark, folder)))
        batch = F.floor(F.hour(F.timestamp_millis("ts")) / 8)
        pages.withColumn("batch", batch).write.partitionBy("batch").parquet(f"{at}/pages")
        stored = spark.read.parquet(f"{at}/pages")
        table = dau_stream.dau_ledger(spark, f"{at}/dau")
        for n in (0, 1, 1, 2):
            landed = active_users.landings(stored.where(F.col("batch") == n).drop("batch"))
            dau_stream.handle_landings(landed, n, lambda: (t.users(spark, folder), t.provinces(spark, folder)), table, t.AS_OF)
        table.compact()
        _DAYS[key] = table
    return _DAYS[key]


def _dau_stored_realtime(spark: SparkSession, folder: str) -> DataFrame:
    """Today's and yesterday's hours from the two days' folders."""
    table = dau_table(spark, folder)
    days = [table.read(part=day).select("dt", "hr", "mid") for day in (DAU_DAY, times.previous_day(DAU_DAY))]
    return serving.dau_realtime(days[0].unionByName(days[1]), DAU_DAY)


def _log(select: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: select(log_split.parse(t.raw_logs(spark, folder)))


def _error_log(parsed: DataFrame) -> DataFrame:
    path = lambda p: F.get_json_object("value", p)
    return log_split.error_logs(parsed).select(
        path("$.common.mid").alias("mid"), path("$.err.msg").alias("msg"), path("$.ts").cast("bigint").alias("ts")
    )


def _log_topics(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(log_split.split(t.raw_logs(spark, folder)), ["topic"], "n")


def _page_topic(spark: SparkSession, folder: str) -> DataFrame:
    messages = log_split.split(t.raw_logs(spark, folder)).where(F.col("topic") == log_split.PAGE_TOPIC)
    return active_users.parse(messages)


def _cdc_facts(spark: SparkSession, folder: str) -> DataFrame:
    changes = change_capture.parse(t.raw_changes(spark, folder))
    facts = change_capture.fact_messages(changes, t.table_roles(spark))
    row = F.from_json("value", "id bigint, user_id bigint, total_amount double")
    return facts.select("topic", row.alias("r")).select("topic", "r.*")


def _cdc_dims(drop_deleted: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        changes = change_capture.parse(t.raw_changes(spark, folder))
        latest = change_capture.latest_dims(change_capture.dim_changes(changes, t.table_roles(spark)), drop_deleted)
        row = F.from_json("data", "gender string, birthday string, name string")
        return latest.select("table_name", "id", "op", row.alias("r")).select("table_name", "id", "op", "r.*")

    return query


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ad_clicks.parse(t.raw_clicks(spark, folder))


def _batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks counted as three batches: hours 0-7, 8-15 and 16-23 of every day."""
    hour = F.hour(F.timestamp_millis(times.text_to_ms(F.col("ts"))))
    return ad_clicks.batch_counts(_clicks(spark, folder), F.floor(hour / 8))


def _replayed(part: int) -> Query:
    return lambda spark, folder: ad_clicks.replay_batches(_batch_counts(spark, folder), CLICK_THRESHOLD)[part]


def _fresh(spark: SparkSession) -> str:
    """A folder of its own for the tables of one run."""
    return f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"


def _click_batches(spark: SparkSession, folder: str, at: str) -> list[tuple[int, DataFrame]]:
    """The clicks of hours 0-7, 8-15 and 16-23 of every day, as three stored batches, the second one twice."""
    hour = F.hour(F.timestamp_millis(times.text_to_ms(F.col("ts"))))
    clicks = _clicks(spark, folder).withColumn("batch", F.floor(hour / 8))
    clicks.write.partitionBy("batch").parquet(f"{at}/clicks")
    stored = spark.read.parquet(f"{at}/clicks")
    return [(n, stored.where(F.col("batch") == n).drop("batch")) for n in (0, 1, 1, 2)]


def _by_batch(part: int) -> Query:
    """The click rule run batch by batch on its tables, as the stream does; the second batch comes twice."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        at = _fresh(spark)
        counts, banned = click_stream.user_ad_ledger(spark, f"{at}/counts"), click_stream.black_list_ledger(spark, f"{at}/banned")
        for batch, clicks in _click_batches(spark, folder, at):
            click_stream.handle_black_list(clicks, batch, counts, banned, CLICK_THRESHOLD)
        return (counts, banned)[part].read()

    return query


def _ledger_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Users loaded by one run, changed by it twice (one change comes twice, with a compaction between) and by a second run."""
    table = KeyedLedger(spark, _fresh(spark), schemas._ddl("gender string, id bigint, birthday string"), ["gender", "id"], "gender")
    users = t.users(spark, folder)
    changed = lambda every, to: users.where(F.col("id") % every == 0).withColumn("birthday", F.lit(to))
    table.bind("first")
    table.write(users, 0)
    table.write(changed(3, "three"), 1)
    table.write(changed(3, "three"), 1)
    table.compact()
    table.bind("second")
    table.write(changed(5, "five"), 0)
    table.bind("first")
    table.write(changed(7, "seven"), 2)
    return table.read()


def _ledger_counter(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks per key from three batches, one of them twice, half of them compacted."""
    at = _fresh(spark)
    table = CounterLedger(spark, f"{at}/counts", schemas.USER_AD_COUNT, ad_clicks.USER_AD, partition="dt")
    for batch, clicks in _click_batches(spark, folder, at):
        table.write(ad_clicks.user_ad_counts(clicks), batch)
    table.compact()
    return table.read()


def _ledger_set(spark: SparkSession, folder: str) -> DataFrame:
    """Users with more clicks on one advertisement than the threshold within one of three batches, one of which comes twice."""
    at = _fresh(spark)
    table = SetLedger(spark, f"{at}/users", schemas.BLACK_LIST, ["userid"])
    for batch, clicks in _click_batches(spark, folder, at):
        counts = ad_clicks.user_ad_counts(clicks)
        table.write(counts.where(F.col("count") > CLICK_THRESHOLD).select("userid"), batch)
    table.compact()
    return table.read()


def _letters(routed: DataFrame) -> DataFrame:
    letters = routing.dead_letters(routed, "T").select(F.from_json("value", "reason string, value string").alias("r"))
    return letters.select("r.reason", "r.value")


def _routes(routed: DataFrame) -> DataFrame:
    return count_by(routed, ["route", "reason"], "n")


def _cdc_routed(spark: SparkSession, folder: str) -> DataFrame:
    return change_capture.routed(t.raw_changes_with_noise(spark, folder), t.table_roles(spark))


def _details_routed(spark: SparkSession, folder: str) -> DataFrame:
    orders = order_wide.routed_orders(t.raw_orders(spark, folder)).where(F.col("route") == routing.STORED)
    return order_wide.routed_details(t.raw_details(spark, folder), orders.select("id", "create_time"))


def _dau_routed(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of the page topic; a few of the log texts are put among them as they came."""
    messages = log_split.split(t.raw_logs(spark, folder))
    return active_users.routed(messages.where(F.col("topic").isin(log_split.PAGE_TOPIC, log_split.DEAD_LETTER_TOPIC)))


def _over_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return ad_clicks.user_ad_counts(_clicks(spark, folder)).where(F.col("count") > CLICK_THRESHOLD)


def _delta_total(spark: SparkSession, folder: str) -> DataFrame:
    """Running totals as the sum of the batches' increments."""
    return sum_by(_batch_counts(spark, folder).drop("batch"), ad_clicks.USER_AD)


QUERIES: dict[str, Query] = {
    # orders
    "order_wide": _wide,
    "order_wide_hot_keys": lambda spark, folder: _wide(spark, folder, small=False),
    "order_wide_24h": lambda spark, folder: _wide(spark, folder, within="24 hours"),
    "order_full_match": lambda spark, folder: order_wide.full_match(
        t.orders(spark, folder), t.details(spark, folder)
    ).select("order__id", "order__total_amount", "detail__id", "detail__split_total_amount"),
    "order_unmatched": lambda spark, folder: order_wide.orders_without_details(
        t.orders(spark, folder), t.details(spark, folder)
    ).select("id", "user_id", "total_amount"),
    "stats_by_item_age": _stats("age", ORDER_DAY),
    "stats_by_item_gender": _stats("gender", ORDER_DAY),
    "stats_by_item_age_all_days": _stats("age", None),
    "stats_by_item_gender_all_days": _stats("gender", None),
    "stats_two_words": _stats("gender", None, "widget RED"),
    "detail_by_item": _detail("detail"),
    "detail_total": _detail("total"),
    "detail_deep_page": _deep_page,
    "detail_next_page": _next_page,
    "top_ages": _top_ages,
    # active users
    "dau_info": _dau,
    "dau_daily": lambda spark, folder: count_by(_dau_keys(spark, folder), ["dt"], "n"),
    "dau_hourly": lambda spark, folder: serving.dau_hourly(_dau_keys(spark, folder)),
    "dau_realtime": lambda spark, folder: serving.dau_realtime(_dau_keys(spark, folder), DAU_DAY),
    "dau_realtime_24h": lambda spark, folder: serving.dau_realtime_24h(_dau_keys(spark, folder), DAU_DAY),
    "dau_stored_info": lambda spark, folder: dau_table(spark, folder).read(),
    "dau_stored_realtime": _dau_stored_realtime,
    # log split
    "log_page": _log(log_split.page_logs),
    "log_display": _log(log_split.display_logs),
    "log_action": _log(log_split.action_logs),
    "log_start": _log(log_split.start_logs),
    "log_error": _log(_error_log),
    "log_dead_letter": _log(log_split.dead_letters),
    "log_topics": _log_topics,
    "log_page_topic": _page_topic,
    # change capture
    "cdc_fact_topics": _cdc_facts,
    "cdc_dim_latest": _cdc_dims(False),
    "cdc_dim_latest_not_deleted": _cdc_dims(True),
    # advertisement clicks
    "ad_user_day_count": lambda spark, folder: ad_clicks.user_ad_counts(_clicks(spark, folder)),
    "ad_over_threshold": _over_threshold,
    "ad_blacklist": _replayed(1),
    "ad_count_filtered": _replayed(0),
    "ad_area_city_count": lambda spark, folder: ad_clicks.area_city_counts(_clicks(spark, folder)),
    # every nation, and at small scale every user, holds more than one part in 256 of the clicks
    "ad_area_city_count_hot_keys": lambda spark, folder: ad_clicks.area_city_counts(
        ad_clicks.parse(t.raw_clicks(spark, folder, small=False))
    ),
    "click_bucket_10s": lambda spark, folder: ad_clicks.click_buckets(_clicks(spark, folder)),
    "click_sliding_60s": lambda spark, folder: ad_clicks.click_trend(_clicks(spark, folder)),
    "delta_counter_total": _delta_total,
    "ad_blacklist_by_batch": _by_batch(1),
    "ad_count_by_batch": _by_batch(0),
    # replay-safe tables
    "ledger_upsert": _ledger_upsert,
    "ledger_counter_total": _ledger_counter,
    "ledger_set": _ledger_set,
    # where each input row goes
    "click_dead_letter": lambda spark, folder: _letters(ad_clicks.routed(t.raw_clicks_with_noise(spark, folder))),
    "order_dead_letter": lambda spark, folder: _letters(order_wide.routed_orders(t.raw_orders(spark, folder))),
    "cdc_dead_letter": lambda spark, folder: _letters(_cdc_routed(spark, folder)),
    "click_accounts": lambda spark, folder: routing.accounts(ad_clicks.routed(t.raw_clicks_with_noise(spark, folder))),
    "order_accounts": lambda spark, folder: routing.accounts(_details_routed(spark, folder)),
    "order_late": lambda spark, folder: _details_routed(spark, folder).where(F.col("route") == routing.LATE).select("id", "order_id", "reason"),
    "cdc_routes": lambda spark, folder: _routes(_cdc_routed(spark, folder)),
    "log_routes": lambda spark, folder: _routes(log_split.routed(t.raw_logs(spark, folder))),
    "dau_routes": lambda spark, folder: _routes(_dau_routed(spark, folder)),
}
