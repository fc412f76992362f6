"""Connected components of an undirected graph by alternating large and small stars; nothing is collected.

Each round links every larger neighbour of a node to the least node it knows, then every node to its least smaller
neighbour. The rows never outnumber the edges by more than the nodes, and rounds grow with the logarithm of the size.

Before that each portion of at most ``PORTION`` edges is contracted in its task: every node is linked to the least that its portion
reaches. A graph of one portion is done then, without a round; a larger one begins its rounds from these stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import BROADCAST_ROWS, cut, swept, tidied

#: Edges that a task contracts, at most.
PORTION = BROADCAST_ROWS


def _least(edges: DataFrame) -> DataFrame:
    """node -> its least neighbour. Written, so that the join that follows may split its large keys."""
    return cut(edges.groupBy("a").agg(F.min("b").alias("m"))).withColumnRenamed("a", "n")


def _rooted(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each node that isn't the least of its component in these edges, and that least node."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(top, nodes), pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the least node that is reachable. Loops are ignored."""
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    portions = max(1, -(-e.count() // PORTION))
    e = cut(e.repartition(portions).mapInArrow(tidied(_contracted), "a long, b long").distinct())
    if portions == 1:
        return _rooted(e)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _least(both).select("n", F.least("n", "m").alias("m"))
        large = cut(both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        low = _least(large)
        small = large.join(low, F.col("a") == F.col("n")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return _rooted(e)
        before = now
        swept(edges.sparkSession)
