"""Connected components by alternating star contractions.

``large_star`` links each node's larger neighbours to the smallest one,
``small_star`` its smaller ones; repeated in turn they leave one star for each
component. Both are aggregates that combine before the shuffle and equi-joins,
so that no node's neighbours meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_counted


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, its smallest node, for every node of an edge.

    Edges have no direction and may repeat; those with a null are left out.
    """
    pairs = edges.dropna(subset=[a, b]).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs, seen = stage_counted(pairs.filter("u <> v").distinct(), "component-edges")
    while seen["rows"]:
        pairs, seen = stage_counted(_small_star(_large_star(pairs)), "component-edges", moved=F.sum(F.col("moved").cast("long")))
        pairs = pairs.drop("moved")
        if not seen["moved"]:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(pairs: DataFrame) -> DataFrame:
    """For each node ``n`` with least neighbour ``m``: every larger neighbour is
    linked to ``m`` instead."""
    both = pairs.select(F.col("u").alias("n"), F.col("v").alias("other")).unionByName(
        pairs.select(F.col("v").alias("n"), F.col("u").alias("other"))
    )
    least = both.groupBy("n").agg(F.least(F.min("other"), F.col("n")).alias("m"))
    linked = both.filter("other > n").join(least, "n")
    return linked.select(F.col("other").alias("u"), F.col("m").alias("v"), (F.col("m") != F.col("n")).alias("moved")).filter("u <> v")


def _small_star(pairs: DataFrame) -> DataFrame:
    """For each node: it and its smaller neighbours are linked to the least."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least, "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved"))
    kept = joined.filter("v = m").select("u", "v", "moved")
    return kept.unionByName(moved).groupBy("u", "v").agg(F.max("moved").alias("moved"))
