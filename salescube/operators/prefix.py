"""Running totals and row numbers over groups of any size.

A window puts a whole group into one task. Here a group is first cut along its sort order into buckets, the buckets are
totalled (partial aggregation, few rows), and each row adds its bucket's offset to a window over its bucket alone. The
result equals the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.sources.scratch import stage


def magnitude(amount: Column | str) -> Column:
    """Bucket number that never falls as the amount grows: quarter-octaves, mirrored below zero, zero on its own."""
    amount = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    steps = F.floor(F.log2(F.abs(amount) + 1) * 4).cast("int") + 1
    return F.when(amount == 0, 0).when(amount < 0, -steps).otherwise(steps)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; the right side's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    condition = None
    for key in keys:
        match = left[key].eqNullSafe(renamed[f"__{key}"])
        condition = match if condition is None else condition & match
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def bucketed(
    df: DataFrame,
    buckets: dict[str, Column],
    order: Sequence[Column],
    numbers: dict[str, Sequence[str]] | None = None,
    sums: dict[str, tuple[str, Sequence[str]]] | None = None,
    bucket_order: Sequence[Column] = (),
) -> DataFrame:
    """Add row numbers and running sums taken along `bucket_order` then `order`.

    `buckets` names the cut columns and their expressions (group keys may be among them), `bucket_order` sorts the
    buckets, `order` the rows of a bucket. `numbers` maps a new column to the keys its numbering restarts on, `sums` maps
    a new column to (summed column, restart keys). Restart keys must be bucket columns.
    """
    numbers, sums = numbers or {}, sums or {}
    keys = list(buckets)
    rows = df.withColumns({k: c for k, c in buckets.items() if k not in df.columns})
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(column).alias(f"__t_{name}") for name, (column, _) in sums.items()],
    )

    def before(total: str, restart: Sequence[str]) -> Column:
        earlier = Window.partitionBy(*restart).orderBy(*bucket_order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(earlier), F.lit(0))

    offsets = totals.select(
        *keys,
        *[before("__n", restart).alias(f"__o_{name}") for name, restart in numbers.items()],
        *[before(f"__t_{name}", restart).alias(f"__o_{name}") for name, (_, restart) in sums.items()],
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    joined = join_null_safe(rows, offsets, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"__o_{n}") + F.row_number().over(inside)).cast("long").alias(n) for n in numbers],
        *[
            (F.col(f"__o_{n}") + F.sum(column).over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias(n)
            for n, (column, _) in sums.items()
        ],
    )


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str, columns: Sequence[Column | str]) -> DataFrame:
    """`columns` of every row and its number along `order` inside its group, as a plain window numbers them.

    Rows are dealt to tasks by ranges of group and order, with bounds that Spark samples from the data, so a group of any size
    (or one long run of equal sums that a later key in `order` sets apart) spreads over tasks. Each range is sorted once and
    written with its places; a row's number is its place plus the rows of its group in earlier ranges. Only wholly equal rows
    share a range. `columns` may be narrower than what `order` reads: nothing else is kept.
    """
    keys = [F.col(f"`{g}`") for g in groups]
    dealt = df.repartitionByRange(*[k.asc_nulls_first() for k in keys], *order)
    placed = stage(
        dealt.sortWithinPartitions(*[k.asc_nulls_first() for k in keys], *order)
        .select(*columns, F.monotonically_increasing_id().alias("__place")), "ranks"
    ).withColumn("__range", F.shiftright("__place", 33))
    ranges = placed.groupBy(*groups, "__range").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *groups, "__range", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift")
    )
    joined = join_null_safe(placed, offsets, [*groups, "__range"])
    return joined.withColumn(name, F.col("__place") + F.col("__shift")).drop("__place", "__range", "__shift")
