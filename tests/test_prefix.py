"""Row numbers from sampled ranges of the order, against the plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from salescube.operators.prefix import ranked

def _order():
    return [F.col("sales").desc(), F.col("label").asc_nulls_first()]


def _plain(df):
    return df.withColumn("n", F.row_number().over(Window.partitionBy("net", "part").orderBy(*_order())))


def test_numbers_equal_the_plain_window(spark):
    """Null groups and labels, ties in the first key, an empty table."""
    for seed in range(4):
        rng = random.Random(seed)
        rows = [(rng.choice(["A", "B", None]), rng.choice([1, None]), rng.choice([0, 0, 0, 5, -3]), None if i == 7 else f"{i:03}") for i in range(seed * 120)]
        df = spark.createDataFrame(rows, "net string, part int, sales int, label string").repartition(5)
        got = ranked(df, ["net", "part"], _order(), "n", df.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, _plain(df).collect()), key=str)


def test_repeated_rows_get_every_number_once(spark):
    df = spark.createDataFrame([("A", 1, 2, "same")] * 40 + [("A", 1, 9, "first")], "net string, part int, sales int, label string").repartition(5)
    got = ranked(df, ["net", "part"], _order(), "n", df.columns).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 42)) and got[0].label == "first"


def test_a_million_tied_rows_spread_over_tasks(spark):
    """One section in which all sales are zero: the label parts it, no range holds half of it, the numbers are the plain ones."""
    df = spark.range(1_000_000).select(F.lit("A").alias("net"), F.lit(1).alias("part"), F.lit(0).alias("sales"), F.md5(F.col("id").cast("string")).alias("label"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(df, ["net", "part"], _order(), "n", df.columns)
        sizes = [spark.read.parquet(f).count() for f in got.inputFiles()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and max(sizes) < 500_000 and sum(sizes) == 1_000_000
    assert got.exceptAll(_plain(df).withColumn("n", F.col("n").cast("long"))).count() == 0
