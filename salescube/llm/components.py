"""Connected components of a large graph by alternating large-star and small-star steps on DataFrames.

Every step points nodes at the smallest node they know of, so groups of any size shrink to stars in a logarithmic number of
rounds, by aggregates and joins on node keys only; nothing is collected but two numbers that tell whether a round changed
anything. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salescube.sources.scratch import stage


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """Columns node and component (the smallest node reachable) of all nodes of `edges` (columns u, v; loops and repeats allowed)."""
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now, before, seen = after, seen, _print(after)
        if seen == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
