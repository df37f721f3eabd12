"""Connected components by contraction, distributed: links and labels stay tables from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); ``root`` is the smallest node of its component.

    Each round every node points to the smallest node around it, and the links are drawn again between what was pointed to.
    Links inside a cluster vanish, so the graph shrinks fast: a star in one round, a path of length n in about log n. Only
    minima by key and joins against one row per key are used, which combine before the shuffle and split under skew.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        points = stored(least.select("node", F.least("node", "m").alias("root")))
        if labels is None:
            labels = points
        else:
            step = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stored(labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        a = points.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = points.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        drawn = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = stored(drawn.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
