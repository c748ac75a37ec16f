"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    near = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("of"))
    return near.select(F.least("m", "a").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; ``edges`` have a < b."""
    least = edges.groupBy(F.col("b").alias("of")).agg(F.min("a").alias("m"))
    moved = edges.join(least, F.col("b") == F.col("of")).select(F.col("m").alias("x"), F.col("a").alias("y"))
    all_edges = moved.union(least.select(F.col("m").alias("x"), F.col("of").alias("y")))
    return all_edges.where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """node, root for each node of ``links`` (a, b, whole numbers), the root being the smallest reachable.

    Links may point either way and repeat. Each round is written to the shared folder.
    A node with very many neighbours is summed before the shuffle and met again in
    a join whose large partitions Spark splits. No links give no nodes.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, before = written(edges.distinct(), purpose), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        edges = written(_small_star(_large_star(edges)), purpose)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select("a", "a").distinct()
    )
