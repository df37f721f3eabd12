"""File sources: static backfill, file streams and tables that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecart import schemas


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as ``value`` rows."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_table(spark: SparkSession, path: str, schema: StructType, base_path: str | None = None) -> DataFrame:
    """A parquet folder, or an empty frame of ``schema`` where the folder is missing."""
    reader = spark.read.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def day_exists(table: DataFrame, day: str, column: str = "dt") -> bool:
    """Whether a day table has rows for ``day``; partition pruning leaves one day to look at."""
    return not table.where(F.col(column) == day).isEmpty()


def day_field(table: DataFrame, day: str, field: str, column: str = "dt") -> DataFrame:
    """One field of one day; empty for a missing day. No row cap."""
    return table.where(F.col(column) == day).select(field)


def table_roles(spark: SparkSession, path: str) -> DataFrame:
    """Which change tables are facts and which are dimensions: ``(table_name, role)``. Read it once per batch."""
    return read_table(spark, path, schemas.TABLE_ROLES)
