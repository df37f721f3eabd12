"""Word search over stored days, and pages however deep."""

import pytest
from pyspark.sql import functions as F

from tidecart.operators.paging import SortKey, page, page_after, seek_page
from tidecart.schemas import _ddl
from tidecart.sinks import DayIndex
from tidecart.sources.folders import matching

LINE = _ddl("dt string, id string, name string, amount double")


@pytest.fixture
def index(spark, tmp_path):
    return DayIndex(spark, str(tmp_path), LINE, "dt", "id", "name")


@pytest.fixture
def write(spark, index):
    return lambda batch, *lines: index.write(spark.createDataFrame(list(lines), LINE), batch)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_search(index, write):
    write(0, ("d1", "1", "Red  Widget", 1.0), ("d1", "2", "red box", 2.0), ("d2", "3", "red widget!", 3.0), ("d1", "4", None, 1.0), ("d1", "5", "redder widget", 1.0))
    write(1, ("d1", "2", "widget, RED and blue", 2.0), ("d1", "6", "", 1.0), ("d1", "7", "Größe widget", 1.0))
    for compacted in (False, True):
        assert ids(index.search("widget RED", "d1")) == ["1", "2"]
        assert ids(index.search("widget")) == ["1", "2", "3", "5", "7"]
        assert ids(index.search("größe", "d1")) == ["7"]
        # an old name's postings are still there, its line is not found by it
        assert ids(index.search("box")) == []
        for nothing in ("widget absent", "", "!!", "wid"):
            assert ids(index.search(nothing, "d1")) == []
        assert ids(index.search("widget", "d9")) == [] and ids(index.read("d2")) == ["3"]
        if not compacted:
            index.compact(1)


def test_a_search_of_one_day_reads_one_day(spark, index, write):
    write(0, *[(f"d{n}", str(n), f"red widget {n}", 1.0) for n in range(20)])
    index.compact(0)
    plan = index.search("red widget", "d7")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("dt=d7" in line or "InMemoryFileIndex(1 paths)" in line for line in scans)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert any("EqualTo(word,widget)" in line for line in scans)
    # only the changed day of either table is written again
    write(1, ("d7", "7", "blue widget", 1.0))
    before = [t._mark().homes for t in index.tables]
    index.compact(1)
    for table, homes in zip(index.tables, before):
        assert {p for p, h in table._mark().homes.items() if homes[p] != h} == {"d7"}
    assert ids(index.search("blue")) == ["7"] and ids(index.search("red", "d7")) == []
    index.vacuum(keep=1, older_than=0)
    assert len(ids(index.search("red"))) == 19 and len(matching(spark, f"{index.table.path}/marks/*")) == 1


KEYS = (SortKey("t", descending=True), SortKey("id"))


@pytest.fixture(scope="module")
def lines(spark):
    """A third of all rows share a time."""
    t = F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.xxhash64("id") % 400))
    return spark.range(3000).select("id", t.alias("t")).cache()


@pytest.mark.parametrize("page_no", [1, 2, 77, 100, 150, 151, 9999])
@pytest.mark.parametrize("most", [50, 100_000])
def test_a_sought_page_is_the_page(lines, page_no, most):
    expected = page(lines, [k.order() for k in KEYS], page_no, 20).collect()
    assert seek_page(lines, KEYS, page_no, 20, most, ranges=8).collect() == expected


def test_a_sought_page_sorts_few_rows(lines):
    found = seek_page(lines, KEYS, 120, 20, most=100, ranges=8)
    # what is left to sort: the conditions of the last ranges, without the order
    assert found.count() == 20
    condition = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in condition
    kept = seek_page(lines, KEYS, 120, 1000, most=100, ranges=8).count()
    assert kept == 0


def test_all_pages_in_turn(lines):
    want = [tuple(r) for r in lines.orderBy(*[k.order() for k in KEYS]).select("t", "id").collect()]
    got, last = [], None
    for _ in range(3):
        rows = [(r["t"], r["id"]) for r in page_after(lines, KEYS, last, 700).collect()]
        got, last = got + rows, rows[-1]
    assert got == want[:2100]


def test_pages_of_little(spark, lines):
    assert seek_page(lines.limit(0), KEYS, 1).collect() == []
    assert seek_page(lines.limit(0), KEYS, 3).collect() == []
    one = spark.createDataFrame([(1, "x")] * 5, "id long, t string")
    assert len(seek_page(one, KEYS, 1, 3, most=1, ranges=4).collect()) == 3
    with pytest.raises(ValueError):
        seek_page(lines, KEYS, 0)
