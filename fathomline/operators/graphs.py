"""Paths in a graph that may be of any size: frontiers and visited nodes are tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.shared import cut


def hops(edges: DataFrame, starts: DataFrame, most: int | None = None, directed: bool = False) -> DataFrame:
    """node, hops, before: for each node that ``starts`` (node) reach over ``edges`` (a, b), the least number of edges to it and
    the least node before it on such a path; 0 and null for starts.

    Each round joins the last frontier with the edges, leaves out what was visited, and is written; there are as many rounds as
    the longest of the shortest paths has edges (``most``, if given)."""
    e = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = cut((e if directed else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))).distinct())
    frontier = cut(starts.select("node").filter("node IS NOT NULL").distinct().withColumn("hops", F.lit(0)).withColumn("before", F.lit(None).cast(dict(e.dtypes)["a"])))
    visited, n = frontier, 0
    while (most is None or n < most) and frontier.limit(1).count():
        n += 1
        reached = e.join(frontier.select(F.col("node").alias("a")), "a").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("before"))
        frontier = cut(reached.join(visited.select("node"), "node", "left_anti").select("node", F.lit(n).alias("hops"), "before"))
        visited = cut(visited.unionByName(frontier))
    return visited


def path(found: DataFrame, node) -> list:
    """The nodes of one path from a start to ``node``, by what ``hops`` gave; empty where it wasn't reached."""
    out = []
    while node is not None and (row := found.filter(F.col("node") == F.lit(node)).select("before").first()) is not None:
        out.append(node)
        node = row["before"]
    return out[::-1]
