"""Connected components of an edge table by alternating large-star and small-star steps.

Only aggregates and equi-joins: no neighbour list is ever built, so a hub with any number of edges is
a partial minimum and a join that Spark can split.  Every step is checkpointed in the session's
checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.session import cut_lineage


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; ``root`` is the smallest node of its component.
    ``edges`` has columns a and b of one orderable type; direction and repetition do not matter."""
    e = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours of a move to the smallest node around a
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: a and its smaller neighbours move to the smallest of them
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        e = cut_lineage(small)
        now = _state(e)
        if now == seen:
            break
        seen = now
    node = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return node.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
