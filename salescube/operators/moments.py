"""Weighted straight lines from stored states that merge.

A state holds the points of a group as weight, number, means, centred second moments and the range of x. Two states make one
without the points: moments add up, plus the spread between the means. A single point is a state as well, so building and merging
are one operation, and a merged state can be merged again. Centring keeps the digits that sums of squares would lose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group is first merged in this many parts, so that one group with most states is not one task.
PARTS = 32
STATE = ["points", "weight", "mean_x", "mean_y", "sxx", "sxy", "syy", "min_x", "max_x"]


def point_states(df: DataFrame, keys: Sequence[str], x: Column, y: Column, weight: Column) -> DataFrame:
    """One state per row with a known x and y and a positive weight."""
    zero = F.lit(0.0)
    named = df.select(*keys, x.cast("double").alias("__x"), y.cast("double").alias("__y"), weight.cast("double").alias("weight"))
    used = named.where(F.col("__x").isNotNull() & F.col("__y").isNotNull() & (F.col("weight") > 0))
    return used.select(
        *keys, F.lit(1).cast("long").alias("points"), "weight", F.col("__x").alias("mean_x"), F.col("__y").alias("mean_y"),
        zero.alias("sxx"), zero.alias("sxy"), zero.alias("syy"), F.col("__x").alias("min_x"), F.col("__x").alias("max_x"),
    )


def _united(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of equal keys as one; sums run in the order of the means, so a retried task adds in the same order."""
    order = [F.col(c) for c in ("mean_x", "mean_y", "weight", "sxx", "syy")]
    group = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.col("weight")
    means = {f"__{c}": F.sum(w * F.col(c)).over(group) / F.sum(w).over(group) for c in ("mean_x", "mean_y")}
    dx, dy = F.col("mean_x") - F.col("__mean_x"), F.col("mean_y") - F.col("__mean_y")
    return states.withColumns(means).groupBy(*keys).agg(
        F.sum("points").alias("points"),
        F.sum("weight").alias("weight"),
        F.first("__mean_x").alias("mean_x"),
        F.first("__mean_y").alias("mean_y"),
        F.sum(F.col("sxx") + w * dx * dx).alias("sxx"),
        F.sum(F.col("sxy") + w * dx * dy).alias("sxy"),
        F.sum(F.col("syy") + w * dy * dy).alias("syy"),
        F.min("min_x").alias("min_x"),
        F.max("max_x").alias("max_x"),
    )


def merged(states: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """One state per distinct keys (no keys: one for all; none without states)."""
    part = F.pmod(F.xxhash64("mean_x", "mean_y", "weight"), F.lit(parts)).alias("__part")
    split = _united(states.select(*keys, part, *STATE), [*keys, "__part"])
    if keys:
        return _united(split, keys).select(*keys, *STATE)
    return _united(split.withColumn("__all", F.lit(0)), ["__all"]).select(*STATE)


def line(states: DataFrame) -> DataFrame:
    """Slope and intercept of each state, with the share explained and the root mean square error of y.

    Fewer than two distinct x leave all four null; points that all have the same y leave the share null.
    """
    slope = F.when(F.col("max_x") > F.col("min_x"), F.try_divide("sxy", "sxx"))
    left = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    return states.withColumn("slope", slope).withColumns({
        "intercept": F.col("mean_y") - F.col("slope") * F.col("mean_x"),
        "explained": F.when(F.col("slope").isNotNull(), F.lit(1.0) - F.try_divide(left, F.col("syy"))),
        "error": F.when(F.col("slope").isNotNull(), F.sqrt(left / F.col("weight"))),
    })
