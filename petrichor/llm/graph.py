"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .phases import Phases


def connected_components(edges: DataFrame, phases: Phases) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    ``edges`` has two integer columns; direction, repeats and self-links don't
    matter, and no edge gives an empty table. A node with very many links costs
    one minimum per task (combined before the shuffle) and an equality join that
    Spark may split, never a list of its neighbours. Each round is landed.
    """
    left, right = edges.columns
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    pairs = phases.land(pairs, "links")
    before = None
    while True:
        seen = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == seen or not seen[0]:
            break
        before = seen
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = phases.land(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, pairs = pairs, phases.land(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        phases.drop(old, large)
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
