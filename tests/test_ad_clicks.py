from functools import reduce
from random import Random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.plans import ad_clicks
from tidecart.streaming import ad_clicks as stream

DAY = 1700006400000  # 2023-11-15 00:00:00


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def clicks(spark, *rows):
    """Rows (user, ad, how many[, ms])."""
    texts = []
    for user, ad, n, *ms in rows:
        texts += [f"{(ms[0] if ms else DAY) + i} East Boston {user} {ad}" for i in range(n)]
    return ad_clicks.parse(lines(spark, *texts))


def test_lines(spark, rows):
    got = ad_clicks.parse(lines(spark, "1700000000123 East Boston 3 5", "1700000000123 East Boston 3", "1 a b 2 ", "", "1 a b 2 4 more"))
    assert rows(got) == [("1", "a", "b", "2", "4"), ("1700000000123", "East", "Boston", "3", "5")]


def test_counts_split_at_midnight_and_skip_bad_times(spark, rows):
    got = ad_clicks.parse(lines(spark, f"{DAY - 1} E B 1 2", f"{DAY} E B 1 2", f"{DAY} E B 1 2", "soon E B 1 2"))
    assert rows(ad_clicks.user_ad_counts(got)) == [("2023-11-14", "1", "2", 1), ("2023-11-15", "1", "2", 2)]
    assert rows(ad_clicks.area_city_counts(got)) == [("2023-11-14", "E", "B", "2", 1), ("2023-11-15", "E", "B", "2", 2)]


@pytest.fixture
def tables(spark, tmp_path):
    return stream.user_ad_ledger(spark, f"{tmp_path}/counts"), stream.black_list_ledger(spark, f"{tmp_path}/banned")


def test_threshold_rule_over_batches(spark, rows, tables):
    counts, banned = tables
    day = "2023-11-15"
    # 31 at once: banned, not stored; 30 at once: stored, not banned
    stream.handle_black_list(clicks(spark, ("hot", "1", 31), ("edge", "1", 30), ("slow", "1", 20)), 0, counts, banned)
    assert rows(counts.read()) == [(day, "edge", "1", 30), (day, "slow", "1", 20)]
    assert rows(banned.read()) == [("hot",)]
    # a banned user no longer counts; passing the threshold over two batches bans, and that batch still counts
    stream.handle_black_list(clicks(spark, ("hot", "1", 1), ("slow", "1", 11), ("slow", "2", 1), ("edge", "2", 5)), 1, counts, banned)
    assert rows(counts.read()) == [(day, "edge", "1", 30), (day, "edge", "2", 5), (day, "slow", "1", 31), (day, "slow", "2", 1)]
    assert rows(banned.read()) == [("hot",), ("slow",)]
    stream.handle_black_list(clicks(spark, ("slow", "3", 2), ("edge", "1", 40)), 2, counts, banned)
    # over the threshold at once: not stored even though an entry exists
    assert (day, "edge", "1", 30) in rows(counts.read())
    assert rows(banned.read()) == [("edge",), ("hot",), ("slow",)]


def test_replay_and_compaction_change_nothing(spark, rows, tables):
    counts, banned = tables
    batches = [clicks(spark, ("a", "1", 20), ("b", "1", 31)), clicks(spark, ("a", "1", 11), ("b", "1", 2)), clicks(spark, ("a", "1", 1), ("c", "9", 3))]
    for i, batch in enumerate(batches):
        for _ in range(2):
            stream.handle_black_list(batch, i, counts, banned)
            counts.compact()
            banned.compact()
    assert rows(counts.read()) == [("2023-11-15", "a", "1", 31), ("2023-11-15", "c", "9", 3)]
    assert rows(banned.read()) == [("a",), ("b",)]


def test_replay_of_a_history_equals_batch_by_batch(spark, rows, tables):
    counts, banned = tables
    batches = [
        clicks(spark, ("a", "1", 3), ("b", "1", 1), ("c", "1", 2, DAY + 86_400_000)),
        clicks(spark, ("a", "1", 1), ("b", "1", 1), ("b", "2", 2), ("c", "1", 1)),
        clicks(spark, ("b", "1", 1), ("c", "2", 3), ("d", "1", 2)),
        clicks(spark, ("b", "1", 1), ("c", "1", 1), ("d", "1", 1)),
    ]
    for i, batch in enumerate(batches):
        stream.handle_black_list(batch, i, counts, banned, threshold=2)
    numbered = [ad_clicks.batch_counts(b, F.lit(i)) for i, b in enumerate(batches)]
    stored, black_list = ad_clicks.replay_batches(reduce(DataFrame.unionByName, numbered), threshold=2)
    assert rows(counts.read()) == rows(stored.select("dt", "userid", "adid", "count"))
    assert rows(banned.read()) == rows(black_list) == [("a",), ("b",), ("c",), ("d",)]


def test_trend(spark, rows):
    got = ad_clicks.click_trend(clicks(spark, ("a", "1", 2, DAY + 9_998), ("b", "1", 1, DAY + 10_000)))
    # 9.998 and 9.999 fall in the first bucket, 10.000 in the second
    assert {(r.bucket_ms - DAY, r["count"]) for r in got.collect()} == {(0, 2), (10_000, 1)}
    assert got.count() == 12
    window = {r.bucket_ms - DAY: r["count"] for r in got.where(f"window_start_ms = {DAY - 50_000}").collect()}
    assert window == {0: 2}


def test_replay_against_brute_force(spark, rows):
    """Random histories, decided click batch by click batch in plain Python."""
    random = Random(7)
    cells = {
        (history, batch, f"h{history}u{random.randrange(3)}", str(random.randrange(3))): random.randrange(1, 5)
        for history in range(30)
        for batch in range(4)
        for _ in range(5)
    }
    counts, banned = {}, set()
    for batch in range(4):
        before = set(banned)
        for (_, b, user, ad), n in cells.items():
            if b != batch or user in before:
                continue
            if n <= 3:
                counts[user, ad] = counts.get((user, ad), 0) + n
            if n > 3 or counts.get((user, ad), 0) > 3:
                banned.add(user)
    history = spark.createDataFrame(
        [(b, "d", user, ad, n) for (_, b, user, ad), n in cells.items()], "batch int, dt string, userid string, adid string, count bigint"
    )
    stored, black_list = ad_clicks.replay_batches(history, threshold=3)
    assert rows(stored, "userid", "adid", "count") == sorted((u, a, n) for (u, a), n in counts.items())
    assert rows(black_list) == [(u,) for u in sorted(banned)]
