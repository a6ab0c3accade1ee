"""Connected components by alternating large and small stars, each round a join and two aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), two longs, but the roots; a root is the smallest node of its component.

    Self-links and repeated edges change nothing; no edges give no rows. A
    round at least halves the distance to the root, so rounds grow with the
    logarithm of the longest path. The edges of one node meet in a sort-merge
    join, which streams them and which adaptive execution splits where it is
    skewed; they are never held together.
    """
    ends = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = written(ends(edges).distinct(), "components")
    state, before = _state(now), None
    while state != before and state[0]:
        # A node's smallest neighbour, or itself, is told to its larger neighbours (large star), and what a node is told to all it is told (small star).
        low = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), "v")).groupBy("u").agg(F.min("v").alias("m"))
        large = now.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).repartition("u").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = written(ends(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))).distinct(), "components")
        state, before = _state(now), state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def joined_components(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """components() of the edges that roots (node, root) stand for and further ones."""
    named = lambda df, c: df.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left").withColumn(c, F.coalesce(f"{c}_root", c)).drop(f"{c}_root")
    more = components(named(named(edges, "a"), "b"))
    if more.isEmpty():
        return roots
    higher = more.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return moved.unionByName(more)
