"""Left, inner and anti lookups of a keyed table, safe for hot and null keys.

Three ways, by size and skew:

* the table is proven small (row count first, from file footers; then bytes): broadcast it;
* otherwise one pass over the fact keys with a fixed-size frequent-items sketch looks for keys that hold more than
  one ``hot_keys``-th of the rows. There are fewer than ``hot_keys`` of them, so their table rows are broadcast,
  and all other rows take a shuffled join in which hot and null keys are spread over the partitions, since they need
  no partner there;
* without hot keys that is a plain shuffled join.

The sketch only steers rows between joins that give the same result. On a streaming fact frame it cannot run; null
keys are spread there too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_KEYS = 256
# Candidates the sketch keeps per reported key, so that no key above the share is missed.
_TRACKED_PER_KEY = 16
_SPREAD = 1024
# Times the bound. Files are compressed, estimates are not exact: only what is far beyond is refused unseen.
_REFUSED = 8


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a static frame is proven to stay within both bounds: by one pass that counts its rows and bytes.

    A frame is refused without a pass where the plan's own estimate, which follows file sizes, is far beyond the bound.
    """
    if df.isStreaming or max_rows <= 0 or _estimated_bytes(df) > _REFUSED * max_bytes:
        return False
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns), F.lit(0))
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def _estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate where it follows file sizes; 0 where it is a guess (joins multiply, other sources are unknown)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    return 0 if size >= 1 << 62 or "Join " in plan.toString() else size


Heavy = tuple[list[Any], bool]


def heavy_keys(df: DataFrame, *keys: str, k: int = HOT_KEYS) -> dict[str, Heavy]:
    """For each key column the fewer than ``k`` non-null keys with at least one ``k``-th of the rows, and whether nulls have that
    share. One pass for all columns."""
    wanted = [F.count(F.lit(1)).alias("rows")]
    for n, key in enumerate(keys):
        sketch = F.expr(f"approx_top_k(`{key}`, {int(k)}, {int(k) * _TRACKED_PER_KEY}) FILTER (WHERE `{key}` IS NOT NULL)")
        wanted += [sketch.alias(f"items{n}"), F.count(key).alias(f"keyed{n}")]
    seen = df.agg(*wanted).first()
    least = max(seen["rows"] / k, 2)
    return {
        key: ([i["item"] for i in seen[f"items{n}"] or [] if i["count"] >= least], seen["rows"] - seen[f"keyed{n}"] >= least)
        for n, key in enumerate(keys)
    }


def heavy_of(facts: DataFrame, *keys: str, hot_keys: int = HOT_KEYS) -> Callable[[str], Heavy]:
    """Heavy keys of ``facts`` by column. The one pass that finds them all is made when the first is asked for, so a chain whose
    tables are all small makes none."""
    found: dict[str, Heavy] = {}

    def of(key: str) -> Heavy:
        if not found:
            found.update(heavy_keys(facts, *keys, k=hot_keys))
        return found[key]

    return of


def lookup(
    facts: DataFrame,
    table: DataFrame,
    fact_key: str,
    table_key: str,
    attributes: Sequence[Column],
    spread_by: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    hot_keys: int = HOT_KEYS,
    heavy: Callable[[str], Heavy] | None = None,
) -> DataFrame:
    """``facts`` with ``attributes`` of the row of ``table`` whose ``table_key`` equals ``fact_key``.

    ``table`` has one row per key. ``spread_by`` names fact columns that vary within one key. ``small`` overrides
    the size check; ``hot_keys=0`` skips the sketch and leaves hot keys to adaptive execution. ``heavy`` gives the heavy keys of
    a column found elsewhere: a chain of lookups takes one pass over its base rows (:func:`heavy_of`), and none over joined ones.
    """
    if how not in ("left", "inner", "anti"):
        raise ValueError(f"unsupported lookup {how!r}")
    right = table.select(F.col(table_key).alias("__key"), *attributes)
    names = right.columns[1:]
    kept = facts.columns
    # Ids arrive as text in logs and as numbers in orders; they are equal when their texts are.
    if dict(facts.dtypes)[fact_key] == dict(right.dtypes)["__key"]:
        left = facts.withColumn("__fact_key", F.col(fact_key))
    else:
        left = facts.withColumn("__fact_key", F.col(fact_key).cast("string"))
        right = right.withColumn("__key", F.col("__key").cast("string"))
    same_key = F.col("__fact_key") == F.col("__key")

    if small is None:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), same_key, how).select(*kept, *names)

    hot: list[Any] = []
    spread_nulls = how != "inner"
    if hot_keys > 0 and not facts.isStreaming:
        hot, many_nulls = heavy(fact_key) if heavy else heavy_keys(left, "__fact_key", k=hot_keys)["__fact_key"]
        if dict(left.dtypes)["__fact_key"] == "string":
            hot = [str(h) for h in hot]
        spread_nulls = spread_nulls and many_nulls
    if not hot and not spread_nulls:
        return left.join(right, same_key, how).select(*kept, *names)

    if hot:
        hot_rows = right.where(F.col("__key").isin(hot)).select(
            F.col("__key").alias("__hot_key"), *[F.col(n).alias(f"__hot_{n}") for n in names]
        )
        left = left.join(F.broadcast(hot_rows), F.col("__fact_key") == F.col("__hot_key"), "left")
    is_hot = F.coalesce(F.col("__fact_key").isin(hot), F.lit(False)) if hot else F.lit(False)
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)) + 1
    left = left.withColumn(
        "__spread", F.when(F.col("__fact_key").isNull() | is_hot, spread).otherwise(F.lit(0).cast("bigint"))
    )
    # Always 0, but not a literal: a literal would be folded away and with it the spreading of the fact side.
    right = right.withColumn("__no_spread", F.pmod(F.xxhash64("__key"), F.lit(1)))
    joined = left.join(right, same_key & (F.col("__spread") == F.col("__no_spread")), "left")
    found = F.col("__key").isNotNull()
    values = [F.col(n) for n in names]
    if hot:
        found = found | F.col("__hot_key").isNotNull()
        values = [F.when(is_hot, F.col(f"__hot_{n}")).otherwise(F.col(n)).alias(n) for n in names]
    if how != "left":
        joined = joined.where(found if how == "inner" else ~found)
    return joined.select(*kept, *values)
