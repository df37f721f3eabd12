import pytest
from pyspark.sql import functions as F

from tidecart import schemas
from tidecart.plans import serving

DAY = "2023-11-14"


@pytest.fixture(scope="module")
def wide(spark):
    rows = [
        # detail_id, create_date, create_time, sku_name, amount, age, gender
        (1, DAY, "2023-11-14 10:00:00", "Red Widget", 1.0, 19, "F"),
        (2, DAY, "2023-11-14 11:00:00", "red widget XL", 2.0, 20, "F"),
        (3, DAY, "2023-11-14 12:00:00", "Widget, red", 4.0, 29, "M"),
        (4, DAY, "2023-11-14 12:00:00", "Red Widget", 8.0, 30, "other"),
        (5, DAY, "2023-11-14 13:00:00", "Red Widget", 16.0, None, None),
        (6, DAY, "2023-11-14 14:00:00", "Red Gear", 32.0, 40, "M"),
        (7, "2023-11-15", "2023-11-15 10:00:00", "Red Widget", 64.0, 40, "M"),
        (8, DAY, "2023-11-14 15:00:00", "Redder Widget", 128.0, 40, "M"),
        (9, DAY, "2023-11-14 15:00:00", None, 256.0, 40, "M"),
        (10, DAY, "2023-11-14 16:00:00", "Blue Widget", 512.0, None, "F"),
    ]
    df = spark.createDataFrame(
        rows, "detail_id bigint, create_date string, create_time string, sku_name string, split_total_amount double, user_age int, user_gender string"
    )
    have = set(df.columns)
    filled = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ORDER_WIDE.fields]
    return df.select(filled)


def test_by_age_band(wide, rows):
    assert rows(serving.stats_by_item(wide, "RED widget", DAY, "age")) == [("20到29岁", 6.0), ("20岁以下", 1.0), ("30岁以上", 8.0)]


def test_all_bands_are_given_when_one_matches(wide, rows):
    assert rows(serving.stats_by_item(wide, "gear", DAY, "age")) == [("20到29岁", 0.0), ("20岁以下", 0.0), ("30岁以上", 32.0)]


def test_by_gender_label(wide, rows):
    # two genders other than F share one row; unknown gender is left out
    assert rows(serving.stats_by_item(wide, "red widget", DAY, "gender")) == [("女", 3.0), ("男", 12.0)]


@pytest.mark.parametrize("item, day", [("nothing", DAY), ("red gear widget", DAY), ("widget", "2020-01-01"), ("", DAY), ("blue", DAY)])
def test_no_match_gives_no_rows_by_age(wide, item, day):
    assert serving.stats_by_item(wide, item, day, "age").count() == 0


def test_unknown_grouping(wide):
    with pytest.raises(ValueError):
        serving.stats_by_item(wide, "red", DAY, "city")


def test_all_days(wide, rows):
    got = serving.stats_by_item(wide, "red widget", None, "gender")
    assert rows(got, "create_date", "name", "value") == [(DAY, "女", 3.0), (DAY, "男", 12.0), ("2023-11-15", "男", 64.0)]


def test_detail_pages(wide):
    first = serving.detail_by_item(wide, DAY, "widget red", 1, 3)
    assert first.total.first().total == 5
    assert first.detail.columns == list(serving.DETAIL_COLUMNS)
    assert [r.sku_name for r in first.detail.collect()] == ["<em>Red</em> <em>Widget</em>", "<em>Widget</em>, <em>red</em>", "<em>Red</em> <em>Widget</em>"]
    second = serving.detail_by_item(wide, DAY, "widget red", 2, 3).detail.collect()
    assert [(r.create_time, r.sku_name) for r in second] == [
        ("2023-11-14 11:00:00", "<em>red</em> <em>widget</em> XL"),
        ("2023-11-14 10:00:00", "<em>Red</em> <em>Widget</em>"),
    ]
    past_end = serving.detail_by_item(wide, DAY, "widget red", 3, 3)
    assert past_end.detail.count() == 0 and past_end.total.first().total == 5
    missing = serving.detail_by_item(wide, "2020-01-01", "red")
    assert missing.detail.count() == 0 and missing.total.first().total == 0


@pytest.fixture(scope="module")
def dau(spark):
    rows = [("a", "2023-11-14", "09"), ("b", "2023-11-14", "09"), ("c", "2023-11-14", "23"), ("a", "2023-11-13", "00"), ("a", "2023-11-12", "05")]
    return spark.createDataFrame(rows, "mid string, dt string, hr string")


def test_dau_realtime(dau, rows):
    assert rows(serving.dau_realtime(dau, DAY)) == [("dauTd", "09", 2), ("dauTd", "23", 1), ("dauTotal", None, 3), ("dauYd", "00", 1)]
    assert rows(serving.dau_realtime(dau, "2023-11-16")) == [("dauTotal", None, 0)]
    assert rows(serving.dau_hourly(dau, "2023-11-13")) == [("2023-11-13", "00", 1)]


def test_dau_24_hours(dau):
    got = {r.hr: (r.today, r.yesterday) for r in serving.dau_realtime_24h(dau, DAY).collect()}
    assert len(got) == 24 and got["09"] == (2, 0) and got["00"] == (0, 1) and got["12"] == (0, 0)
    assert {tuple(r)[1:] for r in serving.dau_realtime_24h(dau, "2024-06-01").collect()} == {(0, 0)}


def test_a_day_query_reads_one_folder_and_few_columns(spark, wide, tmp_path):
    wide.write.partitionBy("create_date").parquet(f"{tmp_path}/wide")
    stored = spark.read.schema(schemas.ORDER_WIDE).parquet(f"{tmp_path}/wide")
    plan = serving.stats_by_item(stored, "red widget", DAY, "gender")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(create_date" in scan and DAY in scan
    assert "ReadSchema: struct<sku_name:string,split_total_amount:double,user_gender:string>" in scan
    assert serving.stats_by_item(stored, "red widget", DAY, "gender").count() == 2
