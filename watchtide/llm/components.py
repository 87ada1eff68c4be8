"""Connected components by alternating large and small stars; no step gathers the neighbours of a node."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchtide.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.withColumnRenamed("m", "v"))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that is not the least of its component, from edges ``(u, v)``.

    Edges may repeat, run in either direction, or join a node to itself; without edges the result is empty. The
    rounds end when nothing changes, after about the logarithm of the longest path.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
