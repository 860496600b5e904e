"""Broadcast a join side only after its size has been measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
TASK_SIZE_CONF = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes, compressed, up to which adaptive execution merges partitions into one task.
TASK_SIZE = "8MB"


def _row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of one row: fixed-width fields at 16 bytes, text at its own length on top."""
    fixed = F.lit(16 * len(schema.fields))
    text = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        for f in schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return reduce(lambda a, b: a + b, text, fixed).cast("long")


def measure_bytes(*frames: DataFrame) -> list[int]:
    """Size of each frame, from one distributed job that returns one row per frame."""
    sums = [
        df.agg(F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes")).select(F.lit(i).alias("frame"), "bytes")
        for i, df in enumerate(frames)
    ]
    found = {row["frame"]: row["bytes"] for row in reduce(DataFrame.unionByName, sums).collect()}
    return [found[i] for i in range(len(frames))]


def bounded_broadcast(*frames: DataFrame, max_bytes: int | None = None) -> list[DataFrame]:
    """Mark each frame for broadcast when it is measured below the bound.

    A larger frame comes back unmarked: the join is then a shuffle join, whose hot keys adaptive execution
    splits. The caller's plan is the same in both cases.
    """
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    return [
        F.broadcast(df) if size <= bound else df
        for df, size in zip(frames, measure_bytes(*frames), strict=True)
    ]


def small_tasks(spark: SparkSession) -> None:
    """Merge shuffle partitions up to `TASK_SIZE`, unless the session names a size.

    A hash aggregate holds narrow rows many times as wide as they are shuffled (306 MB for 7.5 MB, measured), and by default tasks are
    merged until they read 64 MB each.
    """
    if spark.conf.get(TASK_SIZE_CONF, None) is None:
        spark.conf.set(TASK_SIZE_CONF, TASK_SIZE)
