"""One query per operator of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidecart.llm import (
    class_lm,
    decontamination,
    embedding_dedup,
    fill_in_middle,
    jaccard_join,
    kneser_ney,
    language_id,
    packing,
    pii,
    substring_dedup,
    toxicity,
    url_filter,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: run(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": _documents(packing.pack_documents),
    "op2_substring_dedup": _documents(substring_dedup.report),
    "op3_class_lm": _documents(class_lm.report),
    "op4_embedding_dedup": lambda s, d: embedding_dedup.report(table(s, d, "embeddings")),
    "op5_kneser_ney_quality": lambda s, d: kneser_ney.report(table(s, d, "documents"), table(s, d, "labels")),
    "op6_toxicity": lambda s, d: toxicity.report(table(s, d, "documents"), table(s, d, "labels")),
    "op7_decontamination": lambda s, d: decontamination.report(table(s, d, "documents"), table(s, d, "benchmark")),
    "op8_jaccard_join": _documents(jaccard_join.report),
    "op9_language_id": lambda s, d: language_id.report(s, table(s, d, "documents")),
    "op10_pii": _documents(pii.report),
    "op11_url_filter": lambda s, d: url_filter.report(table(s, d, "pages")),
    "op12_fill_in_middle": _documents(fill_in_middle.report),
    "op13_vector_codes": lambda s, d: vector_codes.report(table(s, d, "embeddings")),
}
