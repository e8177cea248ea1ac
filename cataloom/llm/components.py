"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def _linked_to_least(pairs: DataFrame) -> DataFrame:
    """Link every neighbour ``v`` of ``u`` to the least of ``u`` and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of longs -> (node, root) for every node with a link; roots are least nodes.

    Each round first links larger neighbours, then smaller ones, to the least node around (large
    star and small star), and ends in a reliable checkpoint.  Rounds grow with the logarithm of the
    longest chain.  Links may be repeated or loops.
    """
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.union(edges.select("v", "u"))
        large = _linked_to_least(both).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _linked_to_least(large)
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(near.select("u", F.col("m").alias("v"))).distinct())
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
