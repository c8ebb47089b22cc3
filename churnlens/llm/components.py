"""Connected components by alternating large-star and small-star steps.

Both steps are an aggregate (smallest neighbour, combined map-side) and an
equi-join on the node, so a hub is an ordinary skewed join that adaptive
execution splits.  The edge list never grows: each step rewires every edge
towards a smaller node, until all point at the smallest node of their
component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from churnlens.llm.common import stored


def _to_smallest(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Each v of ``links`` (u, v) rewired to the smallest of u and its neighbours in ``pairs``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _to_smallest(both, both.where("v > u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    small = _to_smallest(large, large)
    small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
    return small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself: then v is the smallest of their component."""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))
    seen = edges.select(F.explode(ends).alias("e")).groupBy("e.x").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
    return seen.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(u, v): each node that has an edge and isn't the smallest of its component, with that smallest node.

    ``edges`` has two columns a, b of one orderable type; order, repeats and
    loops don't matter; rows with a null are ignored.  With ``rounds`` the
    steps end after so many: the pairs then connect the same nodes, though not
    always to the smallest.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # every step is written: a step refers to its input several times
    e = stored(e.distinct(), "edges")
    if rounds is not None:
        for _ in range(rounds):
            e = stored(_star(e), "edges")
        return e
    while not _is_done(e):
        e = stored(_star(e), "edges")
    return e
