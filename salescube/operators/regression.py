"""Weighted straight-line fits, one per group, from sums alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_line(df: DataFrame, keys: list[str], x: Column, y: Column, weight: Column) -> DataFrame:
    """Add slope, intercept and point count of y = intercept + slope * x, fitted per key by weighted least squares.

    Points with a null x or y do not take part. Fewer than two distinct x values leave slope and intercept null. The
    centred form keeps the sums small, so large x values lose no digits. Sums run in the order of x, so that a retried task
    adds in the same order.
    """
    group = Window.partitionBy(*keys).orderBy(x).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    used = x.isNotNull() & y.isNotNull()
    w = F.when(used, weight.cast("double"))
    centred = (
        df.withColumns({"__x": F.when(used, x), "__y": F.when(used, y), "__w": w})
        .withColumns({
            "__mx": F.try_divide(F.sum(F.col("__w") * F.col("__x")).over(group), F.sum("__w").over(group)),
            "__my": F.try_divide(F.sum(F.col("__w") * F.col("__y")).over(group), F.sum("__w").over(group)),
            "fit_points": F.count("__w").over(group),
            "__spread": F.max("__x").over(group) > F.min("__x").over(group),
        })
    )
    dx, dy = F.col("__x") - F.col("__mx"), F.col("__y") - F.col("__my")
    slope = F.when(
        F.col("__spread"),
        F.try_divide(F.sum(F.col("__w") * dx * dy).over(group), F.sum(F.col("__w") * dx * dx).over(group)),
    )
    return (
        centred.withColumn("slope", slope)
        .withColumn("intercept", F.col("__my") - F.col("slope") * F.col("__mx"))
        .drop("__x", "__y", "__w", "__mx", "__my", "__spread")
    )
