import pytest

from tidecart import schemas
from tidecart.plans import order_wide

AS_OF = "2023-11-20"


def order(id, user=36, province=3, created="2023-11-14 22:13:20", total=99.5):
    return (id, province, "1001", user, total, 1.0, 2.0, 102.5, 5.0, 0.5, "exp", "ref", created, "op")


def detail(id, order_id, created="2023-11-15 01:00:00", sku="Red Widget", amount=10.0):
    return (id, order_id, 7, 4.5, 2, sku, created, amount, 0.1, 0.2)


@pytest.fixture
def build(spark):
    users = spark.createDataFrame([("36", "F", "2000-02-29")], schemas.USER_INFO)
    provinces = spark.createDataFrame([("3", "P", "CN-11", "CN-BJ", "110000")], schemas.BASE_PROVINCE)

    def run(orders, details, **options):
        return order_wide.order_wide(
            spark.createDataFrame(orders, schemas.ORDER_INFO),
            spark.createDataFrame(details, schemas.ORDER_DETAIL),
            users,
            provinces,
            AS_OF,
            **options,
        )

    return run


def test_wide_record(build):
    row = build([order(101)], [detail(5, 101)]).first()
    assert row.asDict() == {
        "detail_id": 5, "order_id": 101, "sku_id": 7, "order_price": 4.5, "sku_num": 2, "sku_name": "Red Widget",
        "split_total_amount": 10.0, "split_activity_amount": 0.1, "split_coupon_amount": 0.2,
        "province_id": 3, "order_status": "1001", "user_id": 36, "total_amount": 99.5, "activity_reduce_amount": 1.0,
        "coupon_reduce_amount": 2.0, "original_total_amount": 102.5, "feight_fee": 5.0, "feight_fee_reduce": 0.5,
        "expire_time": "exp", "refundable_time": "ref",
        # the line's create time wins; date and hour are the order's
        "create_time": "2023-11-15 01:00:00", "operate_time": "op", "create_date": "2023-11-14", "create_hour": "22",
        "province_name": "P", "province_area_code": "110000", "province_3166_2_code": "CN-BJ", "province_iso_code": "CN-11",
        "user_age": 23, "user_gender": "F",
    }


@pytest.mark.parametrize("small", [None, True, False])
def test_matches_and_missing_dimensions(build, rows, small):
    orders = [order(1), order(2, user=99), order(3, province=99), order(4)]
    details = [detail(10, 1), detail(11, 1), detail(12, 2), detail(13, 3), detail(14, 77)]
    got = build(orders, details, small=small)
    assert rows(got, "detail_id", "order_id", "user_gender", "user_age", "province_name") == [
        (10, 1, "F", 23, "P"),
        (11, 1, "F", 23, "P"),
        (12, 2, None, None, "P"),
        (13, 3, "F", 23, None),
    ]


def test_one_order_with_a_third_of_all_lines(build, rows):
    orders = [order(i) for i in range(400)]
    details = [detail(i, 7 if i % 3 == 0 else i % 400) for i in range(1200)]
    want = build(orders, details, small=True)
    assert rows(build(orders, details, small=False)) == rows(want)
    assert rows(build(orders, details, small=False, hot_keys=0)) == rows(want)


def test_interval_bound(build, rows):
    details = [
        detail(1, 101, "2023-11-15 22:13:20"),
        detail(2, 101, "2023-11-15 22:13:21"),
        detail(3, 101, "2023-11-13 22:13:20"),
        detail(4, 101, "2023-11-13 22:13:19"),
    ]
    assert rows(build([order(101)], details, within="24 hours"), "detail_id") == [(1,), (3,)]
    assert build([order(101)], details).count() == 4


def test_audit(spark, rows):
    orders = spark.createDataFrame([order(1), order(2)], schemas.ORDER_INFO)
    details = spark.createDataFrame([detail(10, 1), detail(11, 1), detail(14, 77), detail(15, None)], schemas.ORDER_DETAIL)
    assert rows(order_wide.orders_without_details(orders, details), "id") == [(2,)]
    for options in ({}, {"small": False}):
        assert rows(order_wide.details_without_order(orders, details, **options), "id") == [(14,), (15,)]


@pytest.mark.parametrize("options", [{}, {"small": False}])
def test_full_match(spark, rows, options):
    orders = spark.createDataFrame([order(1), order(2)], schemas.ORDER_INFO)
    details = spark.createDataFrame([detail(10, 1), detail(14, 77), detail(15, None)], schemas.ORDER_DETAIL)
    got = order_wide.full_match(orders, details, **options)
    assert rows(got, "order__id", "detail__id") == [(None, 14), (None, 15), (1, 10), (2, None)]


def test_json_forms(spark):
    raw = spark.createDataFrame([('{"id":101,"user_id":36,"total_amount":99.5,"create_time":"2023-11-14 22:13:20"}',), (None,)], "value string")
    parsed = order_wide.parse_orders(raw).collect()
    assert [(r.id, r.user_id, r.total_amount) for r in parsed] == [(101, 36, 99.5)]
    quoted = spark.createDataFrame([('{"id":"7","user_id":"x","total_amount":"1.5"}',), ("[1]",), ("no",), ("{}",)], "value string")
    assert [tuple(r) for r in order_wide.parse_orders(quoted).select("id", "user_id", "total_amount").collect()] == [
        (7, None, 1.5),
        (None, None, None),
    ]
    assert order_wide.parse_orders(quoted).dtypes == spark.createDataFrame([], schemas.ORDER_INFO).dtypes
    line = spark.createDataFrame([('{"id":5,"order_id":101,"sku_num":2,"sku_name":"x"}',)], "value string")
    assert tuple(order_wide.parse_details(line).select("id", "order_id", "sku_num", "sku_name").first()) == (5, 101, 2, "x")


def test_lines_of_a_day_are_chosen_before_articles_are_joined(spark, tmp_path, monkeypatch):
    """Order 1 is of the day and comes twice, order 2 is of another day; one line has no order key."""
    from tidecart.demo import queries, tables

    day = "timestamp_ntz'1997-02-01 00:00:00'"
    made = {
        "orders": f"""select * from values (1L, 1L, 'O', 9.0D, {day}), (1L, 1L, 'O', 9.0D, {day}), (null, 1L, 'O', 9.0D, {day}),
            (2L, 1L, 'O', 9.0D, {day} + interval 9 days) as t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate)""",
        "lineitem": f"""select *, 1L as l_suppkey, 2.0D as l_quantity, {day} as l_shipdate, 8.0D as l_extendedprice, 0.5D as l_discount,
            0.5D as l_tax from values (1L, 1, 1L), (1L, 2, null), (2L, 1, 1L), (null, 1, 1L), (3L, 1, 1L) as t(l_orderkey, l_linenumber, l_partkey)""",
        "part": "select 1L as p_partkey, 'red widget' as p_name, 3.0D as p_retailprice",
        "customer": "select 1L as c_custkey, 1L as c_nationkey",
        "nation": "select 1 as n_nationkey, 'N' as n_name",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    named, lookup = [], tables.lookup
    monkeypatch.setattr(tables, "lookup", lambda facts, *rest, **more: named.append(facts.count()) or lookup(facts, *rest, **more))
    wide = queries._wide(spark, str(tmp_path), "1997-02-01").select("order_id", "sku_id", "sku_name")
    assert sorted(map(str, wide.collect())) == sorted(
        2 * [str(r) for r in spark.sql("select 1L order_id, 1L sku_id, 'red widget' sku_name union all select 1L, null, null").collect()]
    )
    assert named == [2]
