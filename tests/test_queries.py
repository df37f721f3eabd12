"""Every registered query equals its SQL on whole tables, and the contract with the driver holds."""

import pytest
from compare import connect, differences
from pyspark.sql import DataFrame

from __spark_entry__ import entry, oracle_sql
from tidecart.demo.oracles import ORACLES
from tidecart.demo.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_contract(spark):
    assert set(QUERIES) == set(ORACLES) and set(ORACLES) <= set(oracle_sql())
    flagship = entry(spark)
    assert isinstance(flagship, DataFrame) and flagship.columns == ["create_date", "name", "value"]
    assert flagship.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    problems, _ = differences(spark, duck, FOLDER, QUERIES[name], ORACLES[name])
    assert not problems
