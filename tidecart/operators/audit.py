"""Row counts that ride along with the job that reads the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row_count(df: DataFrame, name: str) -> DataFrame:
    """Report the number of rows passing this point as metric ``name`` (``observedMetrics`` on streams)."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
