"""Plain SQL over the source tables that gives the same results as :mod:`tidecart.demo.queries`.

Written against the columns of the source tables, without the JSON and text detours of the Spark side.
"""

from __future__ import annotations

from tidecart.demo.queries import CLICK_THRESHOLD, DAU_DAY, DEEP_PAGE, DEEP_SIZE, ORDER_DAY, PAGE_NO, PAGE_SIZE
from tidecart.demo.tables import AS_OF

_USERS = f"""
users AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birthday,
         CAST(date_sub('year', CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS DATE), DATE '{AS_OF}') AS INTEGER) AS age
  FROM customer)"""

_PROVINCES = """
provinces AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
         'ISO-' || n_nationkey AS iso_code, 'CN-' || n_nationkey AS iso_3166_2,
         CAST(100000 + n_nationkey AS VARCHAR) AS area_code
  FROM nation)"""

_ORDERS = """
headers AS (
  SELECT o_orderkey AS id, o_orderkey % 27 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
         o_totalprice AS total_amount, o_totalprice / 8 AS activity_reduce_amount, o_totalprice / 16 AS coupon_reduce_amount,
         o_totalprice + o_totalprice / 8 + o_totalprice / 16 AS original_total_amount,
         CAST(o_orderkey % 20 AS DOUBLE) AS feight_fee, CAST(o_orderkey % 5 AS DOUBLE) AS feight_fee_reduce,
         o_orderdate + to_seconds(o_orderkey % 86400) AS created
  FROM orders)"""

_DETAILS = """
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS detail_id,
         l_orderkey AS order_id, l_partkey AS sku_id, p_retailprice AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
         p_name AS sku_name, l_shipdate + to_seconds(l_orderkey % 86400 + l_linenumber) AS created,
         l_extendedprice AS split_total_amount, l_extendedprice * l_discount AS split_activity_amount,
         l_extendedprice * l_tax AS split_coupon_amount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

_TIME = "'%Y-%m-%d %H:%M:%S'"


def _wide(condition: str = "TRUE") -> str:
    return f"""WITH {_USERS}, {_PROVINCES}, {_ORDERS}, {_DETAILS},
wide AS (
  SELECT l.detail_id, l.order_id, l.sku_id, l.order_price, l.sku_num, l.sku_name,
         l.split_total_amount, l.split_activity_amount, l.split_coupon_amount,
         h.province_id, h.order_status, h.user_id, h.total_amount, h.activity_reduce_amount, h.coupon_reduce_amount,
         h.original_total_amount, h.feight_fee, h.feight_fee_reduce,
         strftime(h.created + to_seconds(900), {_TIME}) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
         strftime(l.created, {_TIME}) AS create_time, strftime(h.created, {_TIME}) AS operate_time,
         strftime(h.created, '%Y-%m-%d') AS create_date, strftime(h.created, '%H') AS create_hour,
         p.name AS province_name, p.area_code AS province_area_code, p.iso_3166_2 AS province_3166_2_code,
         p.iso_code AS province_iso_code, u.age AS user_age, u.gender AS user_gender
  FROM lines l JOIN headers h ON l.order_id = h.id
  LEFT JOIN users u ON h.user_id = u.id LEFT JOIN provinces p ON h.province_id = p.id
  WHERE {condition})
"""


def _words(*wanted: str) -> str:
    listed = ", ".join(f"'{w}'" for w in wanted)
    return f"list_has_all(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), [{listed}])"


_DAY_AND_ITEM = f"create_date = '{ORDER_DAY}' AND {_words('widget')}"

_BANDS = "(VALUES (1, '20岁以下'), (2, '20到29岁'), (3, '30岁以上')) AS b(no, name)"
_BAND_NO = "CASE WHEN user_age < 20 THEN 1 WHEN user_age < 30 THEN 2 ELSE 3 END"

_EVENTS = """
e AS (
  SELECT event_id, user_id AS u, event_type AS kind, value AS val, ts, epoch_us(ts) // 1000 AS ms,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
  FROM events)"""

_DEVICE = """'mid_' || u AS mid, CASE WHEN k % 7 <> 0 THEN CAST(u AS VARCHAR) END AS user_id,
  CAST(u % 27 AS VARCHAR) AS province_id, 'ch_' || (k % 5) AS channel, CAST(k % 2 AS VARCHAR) AS is_new,
  'model_' || (u % 10) AS model, CASE WHEN u % 2 = 0 THEN 'android' ELSE 'ios' END AS operate_system,
  'v2.1.' || (k % 10) AS version_code, 'brand_' || (u % 4) AS brand"""

_PAGE = """CASE kind WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment' ELSE 'home' END AS page_id,
  CASE kind WHEN 'click' THEN 'home' WHEN 'purchase' THEN 'good_detail' END AS last_page_id,
  CAST(k AS VARCHAR) AS page_item, 'sku_id' AS page_item_type, CAST(floor(val * 100) AS BIGINT) AS during_time,
  CASE WHEN k % 2 = 0 THEN 'query' ELSE 'promotion' END AS "sourceType\""""

_IS_PAGE = "k <> 99 AND kind IN ('view', 'click', 'purchase')"
_IS_START = "k <> 99 AND (kind = 'signup' OR (kind = 'purchase' AND k % 10 = 0))"

_PAGES = f"SELECT {_DEVICE}, {_PAGE}, ms AS ts FROM e WHERE {_IS_PAGE}"

_DAU = f"""WITH {_EVENTS}, {_USERS}, {_PROVINCES},
landed AS (SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt FROM ({_PAGES}) WHERE last_page_id IS NULL),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY dt, mid
    ORDER BY ts, user_id NULLS FIRST, province_id, channel, is_new, model, operate_system, version_code, brand, page_id,
             page_item, page_item_type, during_time, "sourceType") AS no
  FROM landed),
dau AS (
  SELECT r.mid, r.user_id, r.province_id, r.channel, r.is_new, r.model, r.operate_system, r.version_code, r.brand,
         r.page_id, r.page_item, r.page_item_type, r."sourceType", r.during_time,
         u.gender AS user_gender, u.age AS user_age, p.name AS province_name, p.iso_code AS province_iso_code,
         p.iso_3166_2 AS province_3166_2, p.area_code AS province_area_code,
         r.dt, strftime(make_timestamp(r.ts * 1000), '%H') AS hr, r.ts
  FROM ranked r LEFT JOIN users u ON r.user_id = CAST(u.id AS VARCHAR)
  LEFT JOIN provinces p ON r.province_id = CAST(p.id AS VARCHAR)
  WHERE r.no = 1)
"""
_YESTERDAY = f"strftime(DATE '{DAU_DAY}' - 1, '%Y-%m-%d')"

_CHANGES = """
changes AS (
  SELECT 'USER_INFO' AS table_name, CAST(c_custkey AS VARCHAR) AS id,
         CASE WHEN c_custkey % 5 = 0 THEN 'D' WHEN c_custkey % 3 = 0 THEN 'U' ELSE 'I' END AS op,
         CASE WHEN c_custkey % 2 = 0 OR (c_custkey % 3 = 0 AND c_custkey % 5 <> 0) THEN 'F' ELSE 'M' END AS gender,
         strftime(DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CAST(NULL AS VARCHAR) AS name
  FROM customer
  UNION ALL
  SELECT 'BASE_PROVINCE', CAST(n_nationkey AS VARCHAR), 'I', NULL, NULL, n_name FROM nation)"""

_CLICKS = f"""{_EVENTS},
clicks AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, replace(r_name, ' ', '_') AS area, n_name AS city,
         CAST(u AS VARCHAR) AS userid, CAST(k % 6 + 1 AS VARCHAR) AS adid, ms, CAST(hour(ts) // 8 AS INTEGER) AS batch
  FROM e LEFT JOIN customer ON u = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

_FOLD = f"""WITH {_CLICKS},
counts AS (SELECT batch, dt, userid, adid, count(*) AS n FROM clicks GROUP BY ALL),
ban0 AS (SELECT DISTINCT userid FROM counts WHERE batch = 0 AND n > {CLICK_THRESHOLD}),
kept0 AS (SELECT dt, userid, adid, n FROM counts WHERE batch = 0 AND n <= {CLICK_THRESHOLD}),
seen1 AS (SELECT c.*, coalesce(s.n, 0) + c.n AS total FROM counts c LEFT JOIN kept0 s USING (dt, userid, adid)
          WHERE c.batch = 1 AND c.userid NOT IN (SELECT userid FROM ban0)),
ban1 AS (SELECT userid FROM ban0 UNION SELECT userid FROM seen1 WHERE n > {CLICK_THRESHOLD} OR total > {CLICK_THRESHOLD}),
kept1 AS (SELECT dt, userid, adid, sum(n) AS n FROM (
            SELECT * FROM kept0 UNION ALL SELECT dt, userid, adid, n FROM seen1 WHERE n <= {CLICK_THRESHOLD}) GROUP BY ALL),
seen2 AS (SELECT c.*, coalesce(s.n, 0) + c.n AS total FROM counts c LEFT JOIN kept1 s USING (dt, userid, adid)
          WHERE c.batch = 2 AND c.userid NOT IN (SELECT userid FROM ban1)),
ban2 AS (SELECT userid FROM ban1 UNION SELECT userid FROM seen2 WHERE n > {CLICK_THRESHOLD} OR total > {CLICK_THRESHOLD}),
kept2 AS (SELECT dt, userid, adid, sum(n) AS n FROM (
            SELECT * FROM kept1 UNION ALL SELECT dt, userid, adid, n FROM seen2 WHERE n <= {CLICK_THRESHOLD}) GROUP BY ALL)
"""

_STATS_AGE = f"SELECT {{keys}}b.name, round(sum(CASE WHEN {_BAND_NO} = b.no THEN split_total_amount ELSE 0 END), 2) AS value"

_LINE_ROUTES = f"""{_ORDERS},
placed AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey % 100 = 3 AS dead, h.id AS found,
         l_shipdate + to_seconds(l_orderkey % 86400 + l_linenumber) BETWEEN h.created - INTERVAL 24 HOUR AND h.created + INTERVAL 24 HOUR AS near
  FROM lineitem LEFT JOIN headers h ON l_orderkey = h.id AND h.id % 50 NOT IN (7, 8)),
routes AS (
  SELECT id, order_id, CASE WHEN dead THEN 'dead' WHEN found IS NULL OR NOT near THEN 'late' ELSE 'stored' END AS route,
         CASE WHEN dead THEN 'not a JSON object' WHEN found IS NULL THEN 'no order' WHEN NOT near THEN 'order too far in time' END AS reason
  FROM placed)"""

ORACLES: dict[str, str] = {
    "order_wide": f"{_wide()} SELECT * FROM wide",
    "order_wide_hot_keys": f"{_wide()} SELECT * FROM wide",
    "order_wide_24h": f"{_wide('l.created BETWEEN h.created - INTERVAL 24 HOUR AND h.created + INTERVAL 24 HOUR')} SELECT * FROM wide",
    "order_full_match": f"""WITH {_ORDERS}, {_DETAILS}
SELECT h.id AS order__id, h.total_amount AS order__total_amount, l.detail_id AS detail__id,
       l.split_total_amount AS detail__split_total_amount
FROM headers h FULL JOIN lines l ON h.id = l.order_id""",
    "order_unmatched": """SELECT o_orderkey AS id, o_custkey AS user_id, o_totalprice AS total_amount
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "stats_by_item_age": f"""{_wide()}
{_STATS_AGE.format(keys='')} FROM wide, {_BANDS} WHERE {_DAY_AND_ITEM} AND user_age IS NOT NULL GROUP BY b.name""",
    "stats_by_item_gender": f"""{_wide()}
SELECT CASE WHEN user_gender = 'F' THEN '女' ELSE '男' END AS name, round(sum(split_total_amount), 2) AS value
FROM wide WHERE {_DAY_AND_ITEM} AND user_gender IS NOT NULL GROUP BY 1""",
    "stats_by_item_age_all_days": f"""{_wide()}
{_STATS_AGE.format(keys='create_date, ')} FROM wide, {_BANDS} WHERE {_words('widget')} AND user_age IS NOT NULL GROUP BY create_date, b.name""",
    "stats_by_item_gender_all_days": f"""{_wide()}
SELECT create_date, CASE WHEN user_gender = 'F' THEN '女' ELSE '男' END AS name, round(sum(split_total_amount), 2) AS value
FROM wide WHERE {_words('widget')} AND user_gender IS NOT NULL GROUP BY 1, 2""",
    "stats_two_words": f"""{_wide()}
SELECT create_date, CASE WHEN user_gender = 'F' THEN '女' ELSE '男' END AS name, round(sum(split_total_amount), 2) AS value
FROM wide WHERE {_words('red', 'widget')} AND user_gender IS NOT NULL GROUP BY 1, 2""",
    "detail_by_item": f"""{_wide()}
SELECT create_time, order_price, province_name, regexp_replace(sku_name, '\\b(widget)\\b', '<em>\\1</em>', 'gi') AS sku_name,
       sku_num, total_amount, user_age, user_gender
FROM wide WHERE {_DAY_AND_ITEM} ORDER BY wide.create_time DESC, detail_id
LIMIT {PAGE_SIZE} OFFSET {(PAGE_NO - 1) * PAGE_SIZE}""",
    "detail_total": f"{_wide()} SELECT count(*) AS total FROM wide WHERE {_DAY_AND_ITEM}",
    "detail_deep_page": f"""{_wide()}
SELECT detail_id, create_time, sku_name, total_amount FROM wide ORDER BY wide.create_time DESC, detail_id
LIMIT {DEEP_SIZE} OFFSET {(DEEP_PAGE - 1) * DEEP_SIZE}""",
    "detail_next_page": f"""{_wide()}
SELECT detail_id, create_time, sku_name, total_amount FROM wide WHERE create_time < '1995-06-01 00:00:00'
ORDER BY wide.create_time DESC, detail_id LIMIT {DEEP_SIZE}""",
    "top_ages": f"""{_wide()}
SELECT user_age, count(*) AS n FROM wide WHERE user_age IS NOT NULL GROUP BY 1 ORDER BY n DESC, user_age LIMIT 24""",
    "dau_info": f"{_DAU} SELECT * FROM dau",
    "dau_stored_info": f"{_DAU} SELECT * FROM dau",
    "dau_stored_realtime": f"""{_DAU}
SELECT 'dauTotal' AS metric, CAST(NULL AS VARCHAR) AS hr, count(*) AS n FROM dau WHERE dt = '{DAU_DAY}'
UNION ALL SELECT 'dauTd', hr, count(*) FROM dau WHERE dt = '{DAU_DAY}' GROUP BY hr
UNION ALL SELECT 'dauYd', hr, count(*) FROM dau WHERE dt = {_YESTERDAY} GROUP BY hr""",
    "dau_daily": f"{_DAU} SELECT dt, count(*) AS n FROM dau GROUP BY dt",
    "dau_hourly": f"{_DAU} SELECT dt, hr, count(*) AS n FROM dau GROUP BY dt, hr",
    "dau_realtime": f"""{_DAU}
SELECT 'dauTotal' AS metric, CAST(NULL AS VARCHAR) AS hr, count(*) AS n FROM dau WHERE dt = '{DAU_DAY}'
UNION ALL SELECT 'dauTd', hr, count(*) FROM dau WHERE dt = '{DAU_DAY}' GROUP BY hr
UNION ALL SELECT 'dauYd', hr, count(*) FROM dau WHERE dt = {_YESTERDAY} GROUP BY hr""",
    "dau_realtime_24h": f"""{_DAU}
SELECT h.hr, count(*) FILTER (WHERE d.dt = '{DAU_DAY}') AS today, count(*) FILTER (WHERE d.dt = {_YESTERDAY}) AS yesterday
FROM (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hr FROM range(24)) h LEFT JOIN dau d ON h.hr = d.hr GROUP BY h.hr""",
    "log_page": f"WITH {_EVENTS} {_PAGES}",
    "log_display": f"""WITH {_EVENTS}
SELECT {_DEVICE}, {_PAGE}, 'promotion' AS display_type, CAST(k + i AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
       CAST(i AS VARCHAR) AS display_order, CAST(i + 1 AS VARCHAR) AS display_pos_id, ms AS ts
FROM e JOIN (VALUES (0), (1), (2)) AS s(i) ON i < k % 3 WHERE k <> 99 AND kind = 'view'""",
    "log_action": f"""WITH {_EVENTS}
SELECT {_DEVICE}, {_PAGE}, 'cart_add' AS action_id, CAST(k + i AS VARCHAR) AS action_item, 'sku_id' AS action_item_type,
       ms + i * 1000 AS action_ts, ms AS ts
FROM e JOIN (VALUES (0), (1), (2)) AS s(i) ON i < k % 3 WHERE k <> 99 AND kind IN ('click', 'purchase')""",
    "log_start": f"""WITH {_EVENTS}
SELECT {_DEVICE}, CASE WHEN k % 2 = 0 THEN 'icon' ELSE 'notice' END AS entry, CAST(k AS VARCHAR) AS open_ad_id,
       CAST(floor(val * 10) AS BIGINT) AS loading_time_ms, k * 10 AS open_ad_ms, CAST(0 AS BIGINT) AS open_ad_skip_ms, ms AS ts
FROM e WHERE {_IS_START}""",
    "log_error": f"WITH {_EVENTS} SELECT 'mid_' || u AS mid, 'e' || k AS msg, ms AS ts FROM e WHERE k <> 99 AND kind = 'error'",
    "log_dead_letter": f"WITH {_EVENTS} SELECT 'broken ' || event_id AS value FROM e WHERE k = 99",
    "log_topics": f"""WITH {_EVENTS}, topics AS (
  SELECT 'DWD_PAGE_LOG_TOPIC' AS topic, count(*) AS n FROM e WHERE {_IS_PAGE}
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC', sum(k % 3) FROM e WHERE k <> 99 AND kind = 'view'
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC', sum(k % 3) FROM e WHERE k <> 99 AND kind IN ('click', 'purchase')
  UNION ALL SELECT 'DWD_START_LOG_TOPIC', count(*) FROM e WHERE {_IS_START}
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC', count(*) FROM e WHERE k <> 99 AND kind = 'error'
  UNION ALL SELECT 'ODS_BASE_LOG_DEAD_LETTER', count(*) FROM e WHERE k = 99)
SELECT topic, CAST(n AS BIGINT) AS n FROM topics WHERE n > 0""",
    "log_page_topic": f"WITH {_EVENTS} {_PAGES}",
    "cdc_fact_topics": """
SELECT 'DWD_ORDER_INFO_' || CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'F' THEN 'U' ELSE 'D' END AS topic,
       o_orderkey AS id, o_custkey AS user_id, o_totalprice AS total_amount FROM orders
UNION ALL SELECT 'DWD_BASE_PROVINCE_I', n_nationkey, NULL, NULL FROM nation""",
    "cdc_dim_latest": f"WITH {_CHANGES} SELECT * FROM changes",
    "cdc_dim_latest_not_deleted": f"WITH {_CHANGES} SELECT * FROM changes WHERE op <> 'D'",
    "ad_user_day_count": f'WITH {_CLICKS} SELECT dt, userid, adid, count(*) AS "count" FROM clicks GROUP BY ALL',
    "ad_over_threshold": f"""WITH {_CLICKS}
SELECT dt, userid, adid, count(*) AS "count" FROM clicks GROUP BY ALL HAVING count(*) > {CLICK_THRESHOLD}""",
    "ad_blacklist": f"{_FOLD} SELECT userid FROM ban2",
    "ad_count_filtered": f'{_FOLD} SELECT dt, userid, adid, CAST(n AS BIGINT) AS "count" FROM kept2',
    "ad_area_city_count": f'WITH {_CLICKS} SELECT dt, area, city, adid, count(*) AS "count" FROM clicks GROUP BY ALL',
    "ad_area_city_count_hot_keys": f'WITH {_CLICKS} SELECT dt, area, city, adid, count(*) AS "count" FROM clicks GROUP BY ALL',
    "click_bucket_10s": f"""WITH {_CLICKS}
SELECT epoch_us(time_bucket(INTERVAL 10 SECOND, make_timestamp(ms * 1000))) // 1000 AS bucket_ms, count(*) AS "count"
FROM clicks GROUP BY 1""",
    "click_sliding_60s": f"""WITH {_CLICKS},
buckets AS (SELECT ms // 10000 * 10000 AS bucket_ms, count(*) AS n FROM clicks GROUP BY 1)
SELECT bucket_ms - back AS window_start_ms, bucket_ms - back + 60000 AS window_end_ms, bucket_ms, n AS "count"
FROM buckets, (VALUES (0), (10000), (20000), (30000), (40000), (50000)) AS o(back)""",
    "delta_counter_total": f'WITH {_CLICKS} SELECT dt, userid, adid, count(*) AS "count" FROM clicks GROUP BY ALL',
    "ad_blacklist_by_batch": f"{_FOLD} SELECT userid FROM ban2",
    "ad_count_by_batch": f'{_FOLD} SELECT dt, userid, adid, CAST(n AS BIGINT) AS "count" FROM kept2',
    "ledger_upsert": f"""WITH {_USERS}
SELECT gender, id, CASE WHEN id % 7 = 0 THEN 'seven' WHEN id % 5 = 0 THEN 'five' WHEN id % 3 = 0 THEN 'three'
  ELSE strftime(birthday, '%Y-%m-%d') END AS birthday FROM users""",
    "ledger_counter_total": f'WITH {_CLICKS} SELECT dt, userid, adid, count(*) AS "count" FROM clicks GROUP BY ALL',
    "ledger_set": f"""WITH {_CLICKS}
SELECT DISTINCT userid FROM (SELECT batch, dt, userid, adid FROM clicks GROUP BY ALL HAVING count(*) > {CLICK_THRESHOLD})""",
    "click_dead_letter": f"""WITH {_EVENTS}
SELECT 'missing fields' AS reason, 'click ' || event_id AS value FROM e WHERE k = 99
UNION ALL SELECT 'time is no number', 'x' || ms || ' AREA CITY ' || u || ' ' || (k % 6 + 1) FROM e WHERE k = 98""",
    "order_dead_letter": """
SELECT 'not a JSON object' AS reason, 'order ' || o_orderkey AS value FROM orders WHERE o_orderkey % 50 = 7
UNION ALL SELECT 'no id', '{"user_id":' || o_custkey || '}' FROM orders WHERE o_orderkey % 50 = 8""",
    "cdc_dead_letter": """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'no id' ELSE 'not a change event' END AS reason,
  CASE WHEN s_suppkey % 2 = 0 THEN '{"type":"insert","table":"user_info","ts":1,"data":{"gender":"F"}}' ELSE 'change ' || s_suppkey END AS value
FROM supplier""",
    "click_accounts": f"""WITH {_EVENTS}
SELECT count(*) AS rows, count(*) FILTER (WHERE k < 98) AS stored, CAST(0 AS BIGINT) AS late, count(*) FILTER (WHERE k >= 98) AS dead,
  CAST(0 AS BIGINT) AS other FROM e""",
    "order_accounts": f"""WITH {_LINE_ROUTES}
SELECT count(*) AS rows, count(*) FILTER (WHERE route = 'stored') AS stored, count(*) FILTER (WHERE route = 'late') AS late,
  count(*) FILTER (WHERE route = 'dead') AS dead, CAST(0 AS BIGINT) AS other FROM routes""",
    "order_late": f"WITH {_LINE_ROUTES} SELECT id, order_id, reason FROM routes WHERE route = 'late'",
    "cdc_routes": """
WITH users AS (SELECT sum(1 + CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) AS good,
                 sum(CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 0 END) AS other FROM customer),
routes AS (
  SELECT 'stored' AS route, NULL AS reason, good + (SELECT count(*) FROM nation) + (SELECT count(*) FROM orders) AS n FROM users
  UNION ALL SELECT 'other', 'no row change', other FROM users
  UNION ALL SELECT 'other', 'table in no role', count(*) FROM part
  UNION ALL SELECT 'dead', 'no id', count(*) FILTER (WHERE s_suppkey % 2 = 0) FROM supplier
  UNION ALL SELECT 'dead', 'not a change event', count(*) FILTER (WHERE s_suppkey % 2 = 1) FROM supplier)
SELECT route, CAST(reason AS VARCHAR) AS reason, CAST(n AS BIGINT) AS n FROM routes WHERE n > 0""",
    "log_routes": f"""WITH {_EVENTS}
SELECT CASE WHEN k = 99 THEN 'dead' ELSE 'stored' END AS route, CASE WHEN k = 99 THEN 'not a JSON object' END AS reason, count(*) AS n
FROM e GROUP BY 1, 2""",
    "dau_routes": f"""WITH {_EVENTS}
SELECT CASE WHEN k = 99 THEN 'dead' WHEN kind = 'view' THEN 'stored' ELSE 'other' END AS route,
  CASE WHEN k = 99 THEN 'not a JSON object' WHEN kind <> 'view' THEN 'opens no visit' END AS reason, count(*) AS n
FROM e WHERE k = 99 OR kind IN ('view', 'click', 'purchase') GROUP BY 1, 2""",
}
