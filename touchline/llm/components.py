"""Connected components of a link table, by alternating stars on Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import cut, spread_join

#: Links that one task joins in memory before it sends on what is left of them.
BLOCK = 2_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task to at most one link for each of its nodes: node -> smallest node it reaches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def rows() -> pa.RecordBatch:
        nodes = [x for x in parent if root(x) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
        if len(parent) > BLOCK:
            yield rows()
            parent.clear()
    yield rows()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node it reaches.

    Null ends and links of a node to itself say nothing and are left out; an empty table
    gives an empty one. Each task first shrinks its links to a forest, so groups of any
    density send no more than one row a node. Then two star steps alternate until the
    links no longer change: every node points to its smallest neighbour, and the
    neighbours of a node are linked to the smallest of them.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    links = links.where("a is not null and b is not null and a <> b")
    edges, before = cut(links.mapInArrow(_forest, "a long, b long")), None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if found == before or not found["n"]:
            break
        before = found
        ends = edges.union(edges.select("b", "a"))
        least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = spread_join(ends, least, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, "a", "b").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(least).distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
