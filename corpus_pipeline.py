"""Cleaning a corpus in five stages, each over everything the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents, the last one the
packed pieces. Rows that repeat a doc_id are handled one by one in every stage; null texts are empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.llm import decontamination, jaccard_join, kneser_ney, packing, pii
from tidecart.llm.common import row_key, small, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text) key is in ``gone`` (doc_key)."""
    keyed = docs.withColumn("doc_key", row_key("doc_id", "text"))
    return keyed.join(small(stored(gone.select("doc_key").distinct()), 24), "doc_key", "left_anti").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, kneser_ney.judge(docs, labels.where("quality = 1")).where("rejected"))


def jaccard_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id. Of repeated rows one stays, and so does
    every document without words once for its id."""
    found = jaccard_join.join_components(docs)
    gone = found.where("n_shingles > 0 and doc_id is not null and doc_id <> component_id")
    return _without(docs, gone).dropDuplicates(["doc_id", "text"])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontamination.phrase_matches(docs, benchmark))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or disguised, is replaced by its kind."""
    masked = pii.find_pii(docs.select(*COLUMNS), mask=True)
    text = F.when(F.col("text").isNotNull(), F.col("clean"))
    return masked.withColumn("text", text).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram jaccard join", jaccard_near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: A language model, tokenization and packing are not SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
