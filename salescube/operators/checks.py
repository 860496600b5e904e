"""Input guards: one distributed aggregate per table, raised or reported before any work starts."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.functions.measures import EXACT


class InputError(ValueError):
    """Input data or parameters a job cannot work with."""


def table_profile(name: str, df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """One row: row count, rows with a null in a required column, keys present more than once, surplus rows.

    Keys are counted through a partial aggregate, so a key repeated a billion times arrives as one row per task.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in required], F.lit(False))
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("null_rows")
    )
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("null_rows"), F.lit(0)).alias("null_rows"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
    ).select(F.lit(name).alias("table_name"), "row_count", "null_rows", "repeated_keys", "surplus_rows")


def dimension_profile(tables: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """Profiles of several tables: name -> (table, key columns, required columns)."""
    return reduce(DataFrame.unionByName, [table_profile(n, df, key, req) for n, (df, key, req) in tables.items()])


def require_clean(tables: dict[str, tuple[DataFrame, list[str], list[str]]]) -> None:
    """Fail on an empty table, a null in a required column or a repeated key. Reads one row per table."""
    problems = []
    for row in dimension_profile(tables).collect():
        if row["row_count"] == 0:
            problems.append(f"{row['table_name']} holds no rows")
        if row["null_rows"]:
            problems.append(f"{row['table_name']} has {row['null_rows']} rows with missing required values")
        if row["repeated_keys"]:
            problems.append(f"{row['table_name']} repeats {row['repeated_keys']} keys, which would multiply sales")
    if problems:
        raise InputError("; ".join(problems))


def not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, failing the job at the first null in a column declared not null.

    The test rides on the pass that reads or writes the table, so it costs no extra scan.
    """

    def guarded(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        message = F.lit(f"null in required column {field.name}")
        return F.coalesce(value, F.raise_error(message).cast(field.dataType)).alias(field.name)

    return df.select(*[guarded(f) for f in schema.fields])


def four_places(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, failing the job at the first value that four decimal places do not hold; sums are exact for all others."""

    def guarded(name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        kept = value.cast(EXACT).cast("double")
        message = F.concat(F.lit(f"{name} needs more than four decimal places: "), value.cast("string"))
        strange = (F.abs(value - kept) > 1e-6) | (value.isNotNull() & kept.isNull())
        return F.when(strange, F.raise_error(message).cast(df.schema[name].dataType)).otherwise(F.col(f"`{name}`"))

    return df.withColumns({name: guarded(name) for name in columns})


def slice_counts(fact: DataFrame) -> DataFrame:
    """Rows per month and network; reads two columns."""
    return fact.groupBy("month_year", "network_name").agg(F.count(F.lit(1)).alias("row_count"))


def require_slices(fact: DataFrame, months: list, chains: list[str], may_be_empty: bool | Collection[tuple] = False) -> None:
    """Every requested month of every requested network must have sales, but for those that may be empty."""
    if may_be_empty is True:
        return
    wanted = fact.where(F.col("month_year").isin(months) & F.col("network_name").isin(chains))
    found = {(r["month_year"], r["network_name"]) for r in slice_counts(wanted).collect()} | set(may_be_empty or ())
    missing = [(m, c) for m in months for c in chains if (m, c) not in found]
    if missing:
        raise InputError("no sales for " + ", ".join(f"{c} in {m}" for m, c in missing))


def require_known(chosen: list[str], known: list[str]) -> None:
    unknown = sorted(set(chosen) - set(known))
    if unknown or not chosen:
        raise InputError(f"unknown networks {unknown}" if unknown else "no network chosen")


def network_mismatch(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales whose own network differs from the network of their store, by pair of names."""
    pairs = fact.groupBy("global_pos_code", "network_name").agg(F.count(F.lit(1)).alias("rows"))
    owners = stores.select("global_pos_code", F.col("network_name").alias("store_network"))
    return (
        pairs.join(owners, "global_pos_code")
        .where(F.col("network_name") != F.col("store_network"))
        .groupBy("network_name", "store_network")
        .agg(F.sum("rows").alias("row_count"))
    )


def network_names(rollup: DataFrame) -> DataFrame:
    """Sorted list of the reporting networks that have data."""
    return rollup.select("network_subname").distinct().orderBy("network_subname")
