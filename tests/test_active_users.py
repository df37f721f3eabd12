import pytest

from tidecart import schemas
from tidecart.plans import active_users

MIDNIGHT = 1700006400000  # 2023-11-15 00:00:00
AS_OF = "2023-11-20"


def page(mid, ts, last=None, user="36", province="3", page_id="home"):
    return (mid, user, province, "ch", "0", "md", "os", "vc", "ba", page_id, last, "7", "sku_id", 12, "query", ts)


@pytest.fixture
def dims(spark):
    users = spark.createDataFrame([("36", "F", "2000-02-29"), ("37", "M", None)], schemas.USER_INFO)
    provinces = spark.createDataFrame([("3", "P", "CN-11", "CN-BJ", "110000")], schemas.BASE_PROVINCE)
    return users, provinces


def daily(spark, dims, *pages, **options):
    return active_users.daily_active(spark.createDataFrame(list(pages), schemas.PAGE_LOG), *dims, AS_OF, **options)


def test_only_landings_count_once_a_day(spark, dims, rows):
    got = daily(
        spark,
        dims,
        page("a", MIDNIGHT - 1),
        page("a", MIDNIGHT - 5, page_id="search"),
        page("a", MIDNIGHT),
        page("b", MIDNIGHT, last="home"),
        page("c", MIDNIGHT + 3_600_000),
    )
    assert rows(got, "dt", "hr", "mid", "ts", "page_id") == [
        ("2023-11-14", "23", "a", MIDNIGHT - 5, "search"),
        ("2023-11-15", "00", "a", MIDNIGHT, "home"),
        ("2023-11-15", "01", "c", MIDNIGHT + 3_600_000, "home"),
    ]
    assert got.columns == schemas.DAU_INFO.names and len(got.columns) == 23


def test_attributes(spark, dims):
    row = daily(spark, dims, page("a", MIDNIGHT)).first()
    assert (row.user_gender, row.user_age) == ("F", 23)
    assert (row.province_name, row.province_iso_code, row.province_3166_2, row.province_area_code) == ("P", "CN-11", "CN-BJ", "110000")


@pytest.mark.parametrize("options", [{}, {"small": False}, {"small": False, "hot_keys": 16}])
def test_unknown_and_anonymous_visitors_are_kept(spark, dims, rows, options):
    got = daily(
        spark,
        dims,
        page("a", MIDNIGHT, user=None),
        page("b", MIDNIGHT, user="99", province="99"),
        page("c", MIDNIGHT, user="37", province=None),
        page("d", MIDNIGHT),
        page("e", MIDNIGHT),
        **options,
    )
    assert rows(got, "mid", "user_gender", "user_age", "province_name") == [
        ("a", None, None, "P"),
        ("b", None, None, None),
        ("c", "M", None, None),
        ("d", "F", 23, "P"),
        ("e", "F", 23, "P"),
    ]


def test_ties_are_settled_by_the_whole_row(spark, dims):
    same = [page("a", MIDNIGHT, page_id=p) for p in ("z", "b", "k")]
    assert {daily(spark, dims, *order).first().page_id for order in (same, same[::-1])} == {"b"}


def test_stored_devices_are_left_out(spark, dims, rows):
    stored = daily(spark, dims, page("a", MIDNIGHT))
    got = daily(spark, dims, page("a", MIDNIGHT + 9), page("a", MIDNIGHT - 9), page("b", MIDNIGHT), stored=stored)
    assert rows(got, "dt", "mid") == [("2023-11-14", "a"), ("2023-11-15", "b")]
