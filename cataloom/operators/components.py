"""Connected components of links inside groups, by rounds of joins with reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def components(links: DataFrame, keys: list[str], one: str, two: str) -> DataFrame:
    """``(*keys, node, component)`` for every end of a link; a component is named by its least node.

    Each round hooks every node's label to the least label around it and then follows labels twice, so
    chains shorten by a factor each round; a star takes three rounds.  Links of a node with many
    neighbours are reduced to their least label in every task before they move.
    """
    there = links.select(*keys, F.col(one).alias("u"), F.col(two).alias("v"))
    edges = checkpointed(there.unionByName(links.select(*keys, F.col(two).alias("u"), F.col(one).alias("v"))).distinct())
    labels = checkpointed(edges.groupBy(*keys, "u").agg(F.least(F.col("u"), F.min("v")).alias("label")))
    while True:
        around = edges.join(labels.select(*keys, F.col("u").alias("v"), F.col("label").alias("near")), [*keys, "v"])
        least = around.groupBy(*keys, "u").agg(F.min("near").alias("least"))
        met = labels.join(least, [*keys, "u"]).select(*keys, "u", "label", F.least("label", "least").alias("new"))
        # The node that a label names hooks on to the least label that any of its followers has met.
        hooks = met.groupBy(*keys, F.col("label").alias("w")).agg(F.min("new").alias("hook"))
        jumped = met.join(hooks.withColumnRenamed("w", "label"), [*keys, "label"]).select(*keys, "u", F.col("label").alias("old"), F.least("new", "hook").alias("via"))
        far = hooks.select(*keys, F.col("w").alias("via"), F.col("hook").alias("end"))
        moved = jumped.join(far, [*keys, "via"], "left").select(*keys, "u", "old", F.least("via", F.coalesce("end", F.col("via"))).alias("label"))
        moved = checkpointed(moved)
        labels = moved.drop("old")
        if moved.filter("label <> old").isEmpty():
            return labels.select(*keys, F.col("u").alias("node"), F.col("label").alias("component"))
