"""Connected components of a graph of any size, by stars that shrink towards the smallest node."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

#: Edges that a task contracts at once.
LOCAL_EDGES = 500_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars: from each of its nodes to the smallest that it reaches here."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = i = parent[up]
        return i

    def stars() -> pa.RecordBatch:
        rows = [(i, root(i)) for i in parent]
        columns = [pa.array([r[i] for r in rows if r[0] != r[1]], pa.int64()) for i in range(2)]
        parent.clear()
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > LOCAL_EDGES:
            yield stars()
    yield stars()


def connected_components(edges: DataFrame, label: str = "component") -> DataFrame:
    """The nodes of ``edges`` (a, b: bigint, a and b not equal) with the smallest node that each can reach.

    Every task first contracts the edges that it has. Then come rounds of two steps, until there are
    only stars: each node hands its smaller neighbours to the smallest of them, and then its larger
    ones. The number of rounds grows with the logarithm of the graph, and each step writes its edges
    to the shared folder. The smallest neighbours are aggregated before they are shuffled, and a node of
    many edges is a large key of one side of a join only, which adaptive execution splits.
    """
    ship(edges.sparkSession)
    current = stage(edges.select("a", "b").mapInArrow(_contracted, "a bigint, b bigint").distinct(), "edges")
    while not _only_stars(current := stage(_small_star(current), "edges")):
        current = stage(_large_star(current), "edges")
    # All edges now lead from a node to the smallest of its component.
    roots = current.select(F.col("b").alias("node"), F.col("b").alias(label)).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias(label)).unionByName(roots)


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or edges from larger ones only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up = 1 and down = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("least"))
    joined = both.where("b > a").join(least, F.col("a") == F.col("key"))
    return joined.select(F.col("b").alias("a"), F.least("key", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("least"))
    moved = edges.join(least, F.col("a") == F.col("key")).where("b <> least")
    own = least.select(F.col("key").alias("a"), F.col("least").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own).distinct()
