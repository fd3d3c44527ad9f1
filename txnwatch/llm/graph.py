"""Connected components of an edge table, for any orderable node type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    # written first: the join then has a plain table on each side and can split a hub's edges
    low = low.select("u", F.least("u", "m").alias("m")).checkpoint()
    return (both.filter(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the smallest node
    of its component.

    Alternating large-star and small-star steps until the edge set is a forest of
    stars.  Minima are partial aggregates and joins, so a hub's neighbours never
    meet in one task as a list.  Each round is checkpointed to the shared folder.
    Self-loops are ignored; an empty edge table gives an empty result.
    """
    edges = edges.select("u", "v").filter("u != v").distinct().checkpoint()
    state = _state(edges)
    while state[0]:
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
