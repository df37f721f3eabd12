import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecart.functions import labels, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "birthday, as_of, age",
    [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-02-29", "2024-02-29", 24),
        ("1990-05-10", "2020-05-09", 29),
        ("1990-05-10", "2020-05-10", 30),
        ("1990-12-31", "2020-01-01", 29),
        (None, "2020-01-01", None),
        ("not a date", "2020-01-01", None),
    ],
)
def test_age_in_whole_years(spark, birthday, as_of, age):
    assert one(spark, times.age_years(F.lit(birthday).cast("string"), as_of)) == age


def test_age_defaults_to_today(spark):
    born = dt.date.today().replace(day=1).replace(year=dt.date.today().year - 40)
    assert one(spark, times.age_years(F.lit(born.isoformat()))) == 40


def test_days_and_hours_of_milliseconds(spark):
    ms = F.lit(1700006399999).cast("bigint")  # 2023-11-14 23:59:59.999
    assert one(spark, times.day_of_ms(ms)) == "2023-11-14"
    assert one(spark, times.hour_of_ms(ms)) == "23"
    assert one(spark, times.day_of_ms(ms + 1)) == "2023-11-15"
    assert one(spark, times.hour_of_ms(ms + 1)) == "00"


def test_parts_of_a_time_text(spark):
    at = F.lit("2023-11-14 02:13:20")
    assert one(spark, times.date_of_text(at)) == "2023-11-14"
    assert one(spark, times.hour_of_text(at)) == "02"
    assert one(spark, times.timestamp_of_text(at)) == dt.datetime(2023, 11, 14, 2, 13, 20)
    assert one(spark, times.timestamp_of_text(F.lit("x"))) is None


def test_floor_and_number_texts(spark):
    assert one(spark, times.floor_ms(F.lit(1700000019999).cast("bigint"))) == 1700000010000
    assert one(spark, times.text_to_ms(F.lit("12"))) == 12
    assert one(spark, times.text_to_ms(F.lit("1x"))) is None
    assert times.previous_day("2024-03-01") == "2024-02-29"


def test_labels(spark):
    got = [one(spark, labels.gender_label(F.lit(g).cast("string"))) for g in ("F", "M", "X", None)]
    assert got == ["女", "男", "男", "男"]
    ages = [one(spark, labels.age_band(F.lit(a).cast("int"))) for a in (19, 20, 29, 30, None)]
    assert ages == ["20岁以下", "20到29岁", "20到29岁", "30岁以上", None]
    assert labels.group_column("age") == "user_age"
    with pytest.raises(ValueError):
        labels.group_column("city")


@pytest.mark.parametrize(
    "name, query, found, marked",
    [
        ("Red Widget", "red", True, "<em>Red</em> Widget"),
        ("Red Widget", "WIDGET red", True, "<em>Red</em> <em>Widget</em>"),
        ("Red Widget", "red gear", False, None),
        ("Redder Widget", "red", False, None),
        ("a.b widget", "a.b", True, "<em>a</em>.<em>b</em> widget"),
        ("axb widget", "a.b", False, None),
        ("red-widget", "widget", True, "red-<em>widget</em>"),
        ("Été Robe", "été", True, "<em>Été</em> Robe"),
        ("Red Widget", " .. ", False, None),
        ("Red Widget", "", False, None),
        (None, "red", None, None),
    ],
)
def test_word_search(spark, name, query, found, marked):
    sku = F.lit(name).cast("string")
    assert one(spark, text.matches_all_words(sku, query)) == found
    if marked is not None:
        assert one(spark, text.highlight(sku, query)) == marked


def test_tokens(spark):
    assert one(spark, text.tokens(F.lit(" Big, red-WIDGET 7 "))) == ["big", "red", "widget", "7"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abAB .-_1é", max_size=8), min_size=1, max_size=20), st.text(alphabet="abA .1é", max_size=4))
def test_word_search_against_brute_force(spark, names, query):
    split = lambda s: set(re.findall(r"[^\W_]+", s.lower()))
    wanted = split(query)
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r["hit"] for r in df.select(text.matches_all_words(F.col("name"), query).alias("hit")).collect()]
    assert got == [bool(wanted) and wanted <= split(n) for n in names]
