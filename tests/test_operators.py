import pytest
from pyspark.sql import functions as F

from tidecart.operators import audit, counting, membership, merge, paging, pick
from tidecart.schemas import _ddl
from tidecart.operators.lookup import fits_broadcast, heavy_keys, lookup


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 facts: a third on key 7, a third on null, one part in 20 on key 999 that has no table row."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, None)
        .when(F.col("id") % 20 == 5, 999)
        .otherwise(F.col("id") % 400)
        .cast("bigint")
    )
    return spark.range(3000).select(F.col("id").alias("fact"), key.alias("k"))


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(500).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") * 2).alias("twice"))


ATTRIBUTES = lambda: [F.col("name"), F.col("twice").alias("t2")]
WAYS = [{"small": True}, {"small": False}, {"small": False, "hot_keys": 0}, {"small": None}]


@pytest.mark.parametrize("options", WAYS)
@pytest.mark.parametrize("how, as_text", [("left", False), ("inner", False), ("anti", False), ("left", True)])
def test_lookup_ways_agree(spark, rows, skewed, table, options, as_text, how):
    facts = skewed.withColumn("k", F.col("k").cast("string")) if as_text else skewed
    attributes = [] if how == "anti" else ATTRIBUTES()
    got = lookup(facts, table, "k", "id", attributes, ["fact"], how=how, **options)
    right = table.select(F.col("id").cast("string" if as_text else "bigint").alias("k"), "name", F.col("twice").alias("t2"))
    want = facts.join(right, "k", f"left_{how}" if how == "anti" else how).select(*got.columns)
    assert got.columns == ["fact", "k"] + ([] if how == "anti" else ["name", "t2"])
    assert rows(got) == rows(want)


def test_heavy_keys_are_found_and_bounded(skewed):
    hot, many_nulls = heavy_keys(skewed, "k", k=64)["k"]
    assert {7, 999} <= set(hot) and len(hot) < 64 and many_nulls
    assert heavy_keys(skewed.where(F.lit(False)), "k", k=64) == {"k": ([], False)}


def test_hot_and_null_keys_are_spread_in_the_shuffled_join(spark, skewed, table):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        joined = lookup(skewed, table, "k", "id", ATTRIBUTES(), ["fact"], small=False)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 1200  # unspread, keys 7 and null alone could fill 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_size_check(table):
    assert fits_broadcast(table)
    assert not fits_broadcast(table, max_rows=499)
    assert not fits_broadcast(table, max_bytes=1000)


def test_unknown_lookup_kind(skewed, table):
    with pytest.raises(ValueError):
        lookup(skewed, table, "k", "id", [], ["fact"], how="full")


def test_first_and_latest_row(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None), ("b", 5, "q")], "k string, at int, v string"
    )
    assert rows(pick.first_by_key(df, ["k"], ["at"])) == [("a", 1, "y"), ("b", 5, None)]
    assert rows(pick.latest_by_key(df, ["k"], ["at"])) == [("a", 2, "x"), ("b", 5, "q")]
    assert pick.first_by_key(df, ["k"], ["at"]).columns == df.columns


def test_one_row_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = pick.first_by_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_merge_by_name_right_wins(spark):
    joined = spark.createDataFrame([(1, "left", 5, 9, "right", 6)], "l_id int, l_x string, l_y int, r_id int, r_x string, r_z int")
    target = _ddl("parent int, child int, x string, y int, z int, none double")
    merged = merge.merge_by_name(joined, "l_", "r_", target, {"l_id": "parent", "r_id": "child"})
    assert tuple(merged.first()) == (1, 9, "right", 5, 6, None)
    assert dict(merged.dtypes)["none"] == "double"


def test_membership(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    keys = spark.createDataFrame([("a",), ("z",)], "name string")
    assert rows(membership.listed(df, "k", keys, "name")) == [("a", 1)]
    assert rows(membership.not_listed(df, "k", keys, "name")) == [(None, 3), ("b", 2)]
    assert rows(membership.not_stored(df, df.where("v = 2"), ["k"])) == [(None, 3), ("a", 1)]


def test_counters(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "k string, count int")
    assert rows(counting.count_by(df, ["k"], "n")) == [("a", 2), ("b", 1)]
    assert rows(counting.sum_by(df, ["k"])) == [("a", 3), ("b", 4)]


def test_buckets_and_windows(spark, rows):
    ms = [(1_000,), (9_999,), (10_000,), (61_000,)]
    df = spark.createDataFrame(ms, "ms bigint").select(F.timestamp_millis("ms").alias("at"))
    counts = counting.bucket_counts(df, "at")
    assert rows(counts) == [(0, 2), (10_000, 1), (60_000, 1)]
    windows = rows(counting.windows_over_buckets(counts))
    assert len(windows) == 18
    want = {(b - back, b - back + 60_000, b, n) for b, n in [(0, 2), (10_000, 1), (60_000, 1)] for back in range(0, 60_000, 10_000)}
    assert set(windows) == want
    # the window 10 s .. 70 s holds the second and third bucket
    assert {w[2] for w in windows if w[0] == 10_000} == {10_000, 60_000}
    with pytest.raises(ValueError):
        counting.windows_over_buckets(counts, 60, 7)


def test_pages_and_top_groups(spark):
    df = spark.range(45).select("id", (F.col("id") % 4).alias("g"))
    order = [F.desc("id")]
    assert [r.id for r in paging.page(df, order).collect()] == list(range(44, 24, -1))
    assert [r.id for r in paging.page(df, order, 3, 20).collect()] == [4, 3, 2, 1, 0]
    assert paging.page(df, order, 4, 20).count() == 0
    assert "TakeOrderedAndProject" in paging.page(df, order, 2)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        paging.page(df, order, 0)
    counts = counting.count_by(df, ["g"], "n")
    assert [tuple(r) for r in paging.top_groups(counts, "n", "g", 2).collect()] == [(0, 12), (1, 11)]


def test_row_counts_ride_along(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    spark.range(7).observe(seen, F.count(F.lit(1)).alias("rows")).where("id > 3").collect()
    assert seen.get == {"rows": 7}
    assert audit.with_row_count(spark.range(7), "named").count() == 7


def test_a_chain_of_lookups_reads_its_base_once(spark):
    """Two lookups by shuffle look for hot keys in one pass over the plain orders."""
    from tidecart import schemas
    from tidecart.plans import order_wide

    orders = spark.range(300).selectExpr("id", "id % 3 AS province_id", "id % 2 AS user_id", "'2023-11-01 10:00:00' AS create_time")
    filled = orders.select(*[F.col(f.name) if f.name in orders.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ORDER_INFO.fields])
    users = spark.range(2).selectExpr("CAST(id AS string) AS id", "'F' AS gender", "'2000-01-01' AS birthday")
    provinces = spark.range(3).selectExpr("CAST(id AS string) AS id", "'p' AS name", "'i' AS iso_code", "'j' AS iso_3166_2", "'a' AS area_code")

    def jobs(group, **options):
        spark.sparkContext.setJobGroup(group, group)
        enriched = order_wide.enrich_orders(filled, users, provinces, "2024-01-30", **options)
        planned = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("", "")
        assert enriched.where("user_gender = 'F' AND province_name = 'p'").count() == 300
        return planned

    one_pass = jobs("one", small=False)
    assert jobs("none", small=False, hot_keys=0) == 0 < one_pass <= 2
