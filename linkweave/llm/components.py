"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, skewed_join, written


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((u, v, m): each edge with the least neighbour of its ``u``, table that it reads).

    The centre of a star may stand in any part of the edges, hence the least neighbours are a table of their own.
    """
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")))
    return skewed_join(edges, least, "u"), least


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found, read = _with_least(both)
    return found.filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")), read


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    found, read = _with_least(down)
    turned = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(read.select("u", F.col("m").alias("v")))
    return turned.filter("u <> v").distinct(), read


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; a component is named by its least node.

    Nodes are strings. Edges are written to the shared folder after each round, so lineage stays short
    and a lost executor costs one round. Ends when a round changes nothing (about log2 of the longest
    path rounds); neighbours of a node are never gathered, only their minimum is.
    """
    now = written(edges.select("u", "v").filter("u <> v").distinct())
    seen = None
    for _ in range(limit):
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen or not mark["n"]:
            break
        seen, before = mark, now
        large, least = _large_star(now)
        large = written(large)
        now, lower = _small_star(large)
        now = written(now)
        forget(before, least, large, lower)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
