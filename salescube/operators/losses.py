"""What the inner joins of the star leave out, told apart in the pass that feeds the job.

Folded sales are marked by the dimensions that lack their codes and written once, by mark. The job goes on with the kept rows;
the others stay as a side table. Both come from committed files, so a task that runs twice counts nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.functions.sizing import bounded_broadcast
from salescube.sources.scratch import new_path

#: The mark of sales that every dimension knows, and the names of the dimensions in marks.
KEPT = "kept"
PRODUCT, STORE, NETWORK = "product", "store", "network"
_CODES = {PRODUCT: "global_sku_code", STORE: "global_pos_code", NETWORK: "global_pos_code"}


@dataclass
class Split:
    """Folded sales by mark: `kept` for the job, `lost` beside it, `marked` with both. `path` is theirs alone."""

    marked: DataFrame
    path: str

    @property
    def kept(self) -> DataFrame:
        return self.marked.where(F.col("loss") == KEPT).drop("loss")

    @property
    def lost(self) -> DataFrame:
        return self.marked.where(F.col("loss") != KEPT)


def _known(dimension: DataFrame, name: str) -> DataFrame:
    """The codes of a dimension, each once, so that a repeated code multiplies nothing here."""
    return dimension.select(_CODES[name]).distinct().withColumn(f"in_{name}", F.lit(True))


def split_sales(folded: DataFrame, skus: DataFrame, stores: DataFrame, networks: DataFrame) -> Split:
    """Mark and store folded sales. `loss` lists the dimensions that lack the row's code, comma-joined: product, store, network.

    Only codes are joined, and broadcast below the measured bound. A null code is known to no dimension. Reading one side later
    opens the files of its marks alone.
    """
    sides = {PRODUCT: skus, STORE: stores, NETWORK: networks}
    known = bounded_broadcast(*[_known(df, name) for name, df in sides.items()])
    marked = folded
    for name, codes in zip(sides, known, strict=True):
        marked = marked.join(codes, _CODES[name], "left")
    missing = F.concat_ws(",", *[F.when(F.col(f"in_{name}").isNull(), F.lit(name)) for name in sides])
    marked = marked.select(*folded.columns, F.when(missing == "", F.lit(KEPT)).otherwise(missing).alias("loss"))
    spark = folded.sparkSession
    path = new_path(spark, "split")
    marked.write.partitionBy("loss").parquet(path, compression="zstd")
    return Split(spark.read.schema(marked.schema).parquet(path), path)


def _totals() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("sales_rows", "pieces", "sales_rub")]


def balance(split: Split) -> DataFrame:
    """Sales rows, pieces and roubles by month and mark; over the marks they add up to the input."""
    return split.marked.groupBy("month_year", "loss").agg(*_totals())


def missing_codes(split: Split) -> DataFrame:
    """Every code that a dimension lacks, with the sales it holds back; a row that lacks two codes counts for both."""
    dimension = F.explode(F.split("loss", ",")).alias("dimension")
    code = F.when(F.col("dimension") == PRODUCT, F.col(_CODES[PRODUCT])).otherwise(F.col(_CODES[STORE]))
    return split.lost.select("*", dimension).groupBy("dimension", code.alias("code")).agg(*_totals())
