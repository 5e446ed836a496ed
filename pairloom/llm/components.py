"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import materialize, skewed_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an (a, b) table; the root is the smallest node reachable.

    Each round hangs all larger neighbours of a node on its smallest neighbour, then all
    smaller ones; the number of rounds grows with the logarithm of the longest path. Every
    round is a stored table, so an executor that is lost costs that round only. Minima combine
    before their shuffle, and a node with very many edges is spread over tasks. Loops and nulls
    are ignored.
    """
    pair = F.col("a") != F.col("b")
    now = _stored(edges.where(pair).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    while before != (mark := _mark(now)):
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hang(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        large = _stored(large)
        small = _hang(large).where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        top = large.groupBy("a").agg(F.min("b").alias("b"))
        now = _stored(small.unionByName(top))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _hang(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return skewed_join(edges, least, "a", salt_by=["b"])


def _stored(edges: DataFrame) -> DataFrame:
    return materialize(edges.distinct(), "edges")


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
