"""Where each row of an input goes, decided once: every row takes exactly one route, so the routes add up to the input.

``stored`` rows feed the tables; ``late`` ones waited in vain; ``dead`` ones are not what they should be and go to a dead-letter
topic with the reason; ``other`` ones are sound but not asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STORED, LATE, DEAD, OTHER = "stored", "late", "dead", "other"
ROUTES = (STORED, LATE, DEAD, OTHER)


def reasons(**cases: Column) -> Column:
    """The name of the first case that holds, blanks for underscores; null if none does."""
    result = F.lit(None).cast("string")
    for name, holds in reversed(cases.items()):
        result = F.when(holds, name.replace("_", " ")).otherwise(result)
    return result


def routed(df: DataFrame, dead: Column | None = None, late: Column | None = None, other: Column | None = None) -> DataFrame:
    """``df`` with ``route`` and ``reason``. Each argument is the reason for its route, null where it does not apply; the first
    of dead, late and other that applies decides."""
    route, reason = F.lit(STORED), F.lit(None).cast("string")
    for name, why in ((OTHER, other), (LATE, late), (DEAD, dead)):
        if why is not None:
            route = F.when(why.isNotNull(), name).otherwise(route)
            reason = F.coalesce(why, reason)
    return df.withColumns({"route": route, "reason": reason})


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("route") == r).alias(r) for r in ROUTES]]


def accounts(df: DataFrame, *keys: str) -> DataFrame:
    """``rows`` and the rows of each route, over all or per ``keys``; ``rows`` is the sum of the others."""
    return df.groupBy(*keys).agg(*_counts())


def watched(df: DataFrame, name: str = "accounts") -> DataFrame:
    """Report the accounts of each batch while it is read, without a pass of their own."""
    return df.observe(name, *_counts())


def accounts_of(query: StreamingQuery, name: str = "accounts") -> dict[int, dict[str, int]]:
    """The accounts of a stream's recent batches that had rows, by batch id."""
    seen = {}
    for progress in query.recentProgress:
        if row := (progress.observedMetrics or {}).get(name):
            if row["rows"]:
                seen[progress.batchId] = row.asDict()
    return seen


def dead_letters(df: DataFrame, topic: str) -> DataFrame:
    """``(topic, value)`` for the dead rows: a JSON text of the reason and the text as it came."""
    letter = F.to_json(F.struct("reason", "value"))
    return df.where(F.col("route") == DEAD).select(F.lit(topic).alias("topic"), letter.alias("value"))
