"""Elasticities of any group of networks or products from one stored table of fit states.

The study leaves one state per product and network. A group's line goes through the covered price bins of all its pairs, just as
if they had been fitted together, without going back to the sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.functions.measures import round_even
from salescube.operators import moments
from salescube.plans.elasticity import PAIR


def states(points: DataFrame) -> DataFrame:
    """One state per pair from its placed and covered bins, on the logarithmic scale; bins without turnover stay out."""
    sold = points.where((F.col("filter") == 1) & (F.col("turnover") > 0))
    return moments.merged(moments.point_states(sold, PAIR, F.ln("price_bin"), F.ln("turnover"), F.col("akb")), PAIR)


def write_states(found: DataFrame, path: str) -> None:
    """Store the states, by network; networks that `found` does not name keep what is stored."""
    (
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("network_subname").parquet(path)
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """Stored states, the network read as text whatever it looks like."""
    numbers = ", ".join(f"{c} {'bigint' if c == 'points' else 'double'}" for c in moments.STATE)
    return spark.read.schema(f"network_subname string, global_sku_code string, {numbers}").parquet(path)


def group_fits(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Elasticity per distinct keys: points, rounded slope and intercept, and quality on the logarithmic scale."""
    lines = moments.line(moments.merged(stored, keys))
    return lines.select(
        *keys,
        "points",
        round_even("slope", 4).alias("ped"),
        round_even("intercept", 4).alias("alpha"),
        round_even("explained", 4).alias("r2_log"),
        round_even("error", 4).alias("rmse_log"),
    )


def all_fits(stored: DataFrame) -> DataFrame:
    """Every pair, every product over all networks, every network over all products, and all together; null stands for all."""
    parts = []
    for keys in (PAIR, ["global_sku_code"], ["network_subname"], []):
        held = group_fits(stored, keys)
        parts.append(held.withColumns({k: F.lit(None).cast("string") for k in PAIR if k not in keys}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
