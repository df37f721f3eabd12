"""The shop's tables derived from the source tables. Every function scans its whole source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.operators.lookup import lookup
from tidecart.operators.membership import listed
from tidecart.operators.parsing import evaluated_once

AS_OF = "2024-01-30"
# More provinces are referred to than exist, so some facts have no province row.
_PROVINCES_REFERRED = 27


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _seconds_after(moment: Column, seconds: Column) -> Column:
    later = F.timestamp_add("SECOND", seconds.cast("int"), moment)
    return F.date_format(later, "yyyy-MM-dd HH:mm:ss")


# --- dimensions ------------------------------------------------------------------------------


def _gender() -> Column:
    return F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M")


def _birthday() -> Column:
    return _text(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int")))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), _gender().alias("gender"), _birthday().alias("birthday")
    )


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    key = _text(F.col("n_nationkey"))
    return source(spark, folder, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("ISO-"), key).alias("iso_code"),
        F.concat(F.lit("CN-"), key).alias("iso_3166_2"),
        _text(F.col("n_nationkey") + 100000).alias("area_code"),
    )


# --- orders ----------------------------------------------------------------------------------


def orders(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Order headers. ``day`` is a coarse typed filter that reaches the scan; the create date still decides."""
    raw = source(spark, folder, "orders")
    if day is not None:
        at = F.lit(day).cast("timestamp_ntz")
        raw = raw.where(F.col("o_orderdate").between(at - F.expr("interval 1 day"), at + F.expr("interval 1 day")))
    created = _seconds_after(F.col("o_orderdate"), F.col("o_orderkey") % 86400)
    total = F.col("o_totalprice")
    return raw.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % _PROVINCES_REFERRED).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        (total / 8).alias("activity_reduce_amount"),
        (total / 16).alias("coupon_reduce_amount"),
        (total + total / 8 + total / 16).alias("original_total_amount"),
        (F.col("o_orderkey") % 20).cast("double").alias("feight_fee"),
        (F.col("o_orderkey") % 5).cast("double").alias("feight_fee_reduce"),
        _seconds_after(F.col("o_orderdate"), F.col("o_orderkey") % 86400 + 900).alias("expire_time"),
        F.lit(None).cast("string").alias("refundable_time"),
        created.alias("create_time"),
        created.alias("operate_time"),
    )


def details(spark: SparkSession, folder: str, of: DataFrame | None = None) -> DataFrame:
    """Order lines with their article name. No single source column is a key, so the line id joins five of them. With ``of``
    (order headers) only the lines of these orders are taken, before anything is joined to them."""
    raw = source(spark, folder, "lineitem")
    if of is not None:
        raw = listed(raw, "l_orderkey", of, "id")
    lines = raw.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")
        ).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        _seconds_after(F.col("l_shipdate"), F.col("l_orderkey") % 86400 + F.col("l_linenumber")).alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("split_activity_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("split_coupon_amount"),
    )
    article = [F.col("p_name").alias("sku_name"), F.col("p_retailprice").alias("order_price")]
    named = lookup(lines, source(spark, folder, "part"), "sku_id", "p_partkey", article, ["id"])
    return named.select(*schemas.ORDER_DETAIL.names)


# --- application logs ------------------------------------------------------------------------


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def raw_logs(spark: SparkSession, folder: str) -> DataFrame:
    """One log text per event: errors, starts, and pages with displays and actions; a few texts are broken."""
    e = source(spark, folder, "events").select("event_id", "user_id", "event_type", "value", _millis().alias("ms"), _k().alias("k"))
    user, k, kind = F.col("user_id"), F.col("k"), F.col("event_type")
    common = F.struct(
        _text(user % _PROVINCES_REFERRED).alias("ar"),
        F.when(k % 7 != 0, _text(user)).alias("uid"),
        F.when(user % 2 == 0, "android").otherwise("ios").alias("os"),
        F.concat(F.lit("ch_"), k % 5).alias("ch"),
        _text(k % 2).alias("is_new"),
        F.concat(F.lit("model_"), user % 10).alias("md"),
        F.concat(F.lit("mid_"), user).alias("mid"),
        F.concat(F.lit("v2.1."), k % 10).alias("vc"),
        F.concat(F.lit("brand_"), user % 4).alias("ba"),
    )
    page = F.struct(
        F.when(kind == "click", "good_detail").when(kind == "purchase", "payment").otherwise("home").alias("page_id"),
        _text(k).alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.floor(F.col("value") * 100).alias("during_time"),
        F.when(kind == "click", "home").when(kind == "purchase", "good_detail").alias("last_page_id"),
        F.when(k % 2 == 0, "query").otherwise("promotion").alias("source_type"),
    )
    steps = F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), 1, (k % 3).cast("int"))
    displays = F.transform(
        steps,
        lambda i: F.struct(
            F.lit("promotion").alias("display_type"),
            _text(k + i).alias("item"),
            F.lit("sku_id").alias("item_type"),
            _text(i + 1).alias("pos_id"),
            _text(i).alias("order"),
        ),
    )
    actions = F.transform(
        steps,
        lambda i: F.struct(
            F.lit("cart_add").alias("action_id"),
            _text(k + i).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (F.col("ms") + i * 1000).alias("ts"),
        ),
    )
    start = F.struct(
        F.when(k % 2 == 0, "icon").otherwise("notice").alias("entry"),
        _text(k).alias("open_ad_id"),
        F.floor(F.col("value") * 10).alias("loading_time"),
        (k * 10).alias("open_ad_ms"),
        F.lit(0).alias("open_ad_skip_ms"),
    )
    error = F.struct(F.concat(F.lit("e"), k).alias("msg"), k.alias("error_code"))
    message = F.struct(
        common.alias("common"),
        F.when(kind != "signup", page).alias("page"),
        F.when(kind == "view", displays).alias("displays"),
        F.when(kind.isin("click", "purchase"), actions).alias("actions"),
        F.when((kind == "signup") | ((kind == "purchase") & (k % 10 == 0)), start).alias("start"),
        F.when(kind == "error", error).alias("err"),
        F.col("ms").alias("ts"),
    )
    broken = F.concat(F.lit("broken "), F.col("event_id"))
    return evaluated_once(e, F.when(k == 99, broken).otherwise(F.to_json(message)), "value")


# --- change events ---------------------------------------------------------------------------


def table_roles(spark: SparkSession) -> DataFrame:
    rows = [("order_info", "fact"), ("base_province", "fact"), ("base_province", "dim"), ("user_info", "dim")]
    return spark.createDataFrame(rows, schemas.TABLE_ROLES)


def raw_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change texts: users (loaded, some updated, some deleted), provinces, orders, a table nobody asked for, and kinds that are
    no row changes. Updates share a second over two transactions, the second closed by an event without an offset."""

    def event(kind, table: str, ts: int, data: Column, **place: int) -> Column:
        kind = kind if isinstance(kind, Column) else F.lit(kind)
        more = [F.lit(v).alias(k) for k, v in place.items()]
        return F.to_json(F.struct(kind.alias("type"), F.lit(table).alias("table"), F.lit(ts).alias("ts"), *more, data.alias("data")))

    key = F.col("c_custkey")
    user = F.struct(key.alias("id"), _gender().alias("gender"), _birthday().alias("birthday"))
    updated = F.struct(key.alias("id"), F.lit("F").alias("gender"), _birthday().alias("birthday"))
    history = F.array(
        event("bootstrap-insert", "user_info", 1, user),
        F.when(key % 3 == 0, event("update", "user_info", 2, user, xid=1, xoffset=5)),
        F.when(key % 3 == 0, event("update", "user_info", 2, user, xid=2, xoffset=0)),
        F.when(key % 3 == 0, event("update", "user_info", 2, updated, xid=2)),
        F.when(key % 7 == 0, event("bootstrap-start", "user_info", 9, updated)),
        F.when(key % 7 == 0, event("table-alter", "order_info", 9, updated)),
        F.when(key % 5 == 0, event("delete", "user_info", 3, user)),
    )
    user_events = source(spark, folder, "customer").select(F.explode(history).alias("value"))
    province = F.struct(*provinces(spark, folder).columns)
    province_events = provinces(spark, folder).select(event("bootstrap-insert", "base_province", 1, province).alias("value"))
    status = F.col("o_orderstatus")
    order_kind = F.when(status == "O", "insert").when(status == "F", "update").otherwise("delete")
    order = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("total_amount")
    )
    order_events = source(spark, folder, "orders").select(event(order_kind, "order_info", 1, order).alias("value"))
    article = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    other_events = source(spark, folder, "part").select(event("insert", "sku_info", 1, article).alias("value"))
    return (
        user_events.where(F.col("value").isNotNull())
        .unionByName(province_events)
        .unionByName(order_events)
        .unionByName(other_events)
    )


# --- advertisement clicks --------------------------------------------------------------------


def raw_clicks(spark: SparkSession, folder: str, **lookup_options) -> DataFrame:
    """One click line per event: time, region and nation of the user, user, advertisement."""
    e = source(spark, folder, "events").select(_millis().alias("ms"), "user_id", _k().alias("k"))
    nation = F.col("c_nationkey").alias("nation_id")
    placed = lookup(e, source(spark, folder, "customer"), "user_id", "c_custkey", [nation], ["ms", "k"], **lookup_options)
    nations = source(spark, folder, "nation").join(
        source(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    names = [F.replace("r_name", F.lit(" "), F.lit("_")).alias("area"), F.col("n_name").alias("city")]
    placed = lookup(placed, nations, "nation_id", "n_nationkey", names, ["ms", "k"], **lookup_options)
    return placed.select(F.concat_ws(" ", "ms", "area", "city", "user_id", F.col("k") % 6 + 1).alias("value"))


# --- inputs with texts that are not what they should be ----------------------------------------


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order texts; of fifty orders one is no JSON and one has no id."""
    rows = orders(spark, folder)
    text = (
        F.when(F.col("id") % 50 == 7, F.concat(F.lit("order "), "id"))
        .when(F.col("id") % 50 == 8, F.to_json(F.struct("user_id")))
        .otherwise(F.to_json(F.struct(*rows.columns)))
    )
    return evaluated_once(rows, text, "value")


def raw_details(spark: SparkSession, folder: str) -> DataFrame:
    """Line texts with a number as id; those of a few articles are no JSON."""
    line = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _seconds_after(F.col("l_shipdate"), F.col("l_orderkey") % 86400 + F.col("l_linenumber")).alias("create_time"),
    )
    text = F.when(F.col("l_partkey") % 100 == 3, F.concat(F.lit("line "), "l_orderkey")).otherwise(F.to_json(line))
    return evaluated_once(source(spark, folder, "lineitem"), text, "value")


def raw_changes_with_noise(spark: SparkSession, folder: str) -> DataFrame:
    """Change texts, and for each supplier a text that is none or a user without an id."""
    nobody = F.lit('{"type":"insert","table":"user_info","ts":1,"data":{"gender":"F"}}')
    text = F.when(F.col("s_suppkey") % 2 == 0, nobody).otherwise(F.concat(F.lit("change "), "s_suppkey"))
    return raw_changes(spark, folder).unionByName(source(spark, folder, "supplier").select(text.alias("value")))


def raw_clicks_with_noise(spark: SparkSession, folder: str) -> DataFrame:
    """Click lines; some have missing fields, some a time that is no number."""
    e = source(spark, folder, "events").select("event_id", _millis().alias("ms"), "user_id", _k().alias("k"))
    line = F.concat_ws(" ", "ms", F.lit("AREA"), F.lit("CITY"), "user_id", F.col("k") % 6 + 1)
    text = F.when(F.col("k") == 99, F.concat(F.lit("click "), "event_id")).when(F.col("k") == 98, F.concat(F.lit("x"), line))
    return e.select(F.coalesce(text, line).alias("value"))
