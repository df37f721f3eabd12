import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (900, None, None, "x", None),
    (901, "", "en", None, 0),
    (902, " \t\n ", "en", "x", 3),
    (903, "one", None, "x", 3),
    (904, "one", "en", "x", 3),
    (905, "same words in a row " * 30, "en", "x", 600),
    (905, "same words in a row " * 30, "en", "x", 600),
    (906, "w " * 6000 + "a.b@c.de +1 (414) 555-7134 éÉ <|endoftext|> ", "fr", "x", 1),
    (None, "a row without an id and a few words more than ten of them", "en", "x", 1),
]


@pytest.fixture(scope="session")
def documents(spark):
    """The small table and rows with nulls, empty and long texts, repeats, and a column that clashes with a result's."""
    base = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(ODD, base.schema)
    from pyspark.sql import functions as F

    return base.union(odd).withColumn("score", F.lit("clash")).withColumn("n_words", F.lit(None).cast("string")).cache()


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
