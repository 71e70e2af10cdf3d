"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of the edges (a, b): root is the smallest id of its component.

    A step joins each node's edges with its smallest neighbour, so a hot node is a skewed join, which Spark splits, and no
    task or driver holds a component. The edges after each round are a table in the shared folder.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        now, before = written(small, "edges"), state
        state = _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
