"""Connected components of an edge table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for all nodes of edges (a, b).

    Each round links every node's larger neighbours, then its smaller ones, to the
    smallest neighbour. Rounds end when no edge changes; their number grows with the
    logarithm of the longest path. Every round is written to the shared folder, so
    neither lineage nor the driver holds it. Nodes with many neighbours are met by
    partial aggregates and by joins of two exchanges, which can be split.
    """
    spark = edges.sparkSession
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(spark, flat.where("u <> v").distinct(), "star-edges")
    before = None
    while True:
        large = _star(now, larger_only=True)
        small = stored(spark, _star(large, larger_only=False), "star-edges")
        mark = small.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        now = small
        if mark == before:
            break
        before = mark
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return stars.unionByName(roots)


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Edges (u > v). Large star: a node's larger neighbours point to the smallest of
    its neighbourhood. Small star: the node and its smaller neighbours do."""
    spark = edges.sparkSession
    if larger_only:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = stored(spark, least.select(F.col("u").alias("w"), F.least("w", "low").alias("m")), "star-least")
    met = both.join(least, both["u"] == least["w"])
    if larger_only:
        new = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        )
    return new.where("u <> v").distinct()
