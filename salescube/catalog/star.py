"""The retail star mapped onto the given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.functions.measures import EXACT
from salescube.functions.sizing import bounded_broadcast


@dataclass
class Star:
    """Tables of one star; `fact` has the columns every rollup needs, `full_fact` all eight."""

    fact: DataFrame
    base_sku: DataFrame
    base_sales_point: DataFrame
    networks: DataFrame

    @property
    def full_fact(self) -> DataFrame:
        (stores,) = bounded_broadcast(self.base_sales_point.select("global_pos_code", "network_name", "network_subname"))
        return self.fact.join(stores, "global_pos_code").select(
            "month_year", "week_start_date", "network_name", "network_subname",
            "global_sku_code", "global_pos_code", "pieces", "sales_rub",
        )


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table under its declared schema, so that no job is spent on reading footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.date_trunc("month", day).cast("date").alias("month_year"),
        F.date_trunc("week", day).cast("date").alias("week_start_date"),
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("pieces"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(EXACT).alias("sales_rub"),
    )


def _text(column: str):
    return F.col(column).cast("string")


def fine_star(spark: SparkSession, sf_dir: str) -> Star:
    """Product = part, store = supplier, network = region, reporting network = nation."""
    part = table(spark, sf_dir, "part")
    brand_number = F.substring("p_brand", 7, 10).cast("int")
    base_sku = part.select(
        _text("p_partkey").alias("global_sku_code"),
        F.col("p_type").alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("segment"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("group"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Producer "), (brand_number % 5).cast("string")).alias("producer"),
        F.col("p_name").alias("global_sku_name"),
        (F.col("p_size") * 100).cast("double").alias("weight"),
    )
    # nation and region hold 25 and 5 rows at every scale
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    stores = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("s_suppkey").alias("global_pos_code"),
            F.col("r_name").alias("network_name"),
            F.col("n_name").alias("network_subname"),
            F.when(F.col("s_acctbal") < 0, F.lit("wholesale")).otherwise(F.lit("retail")).alias("store_format"),
            F.concat(F.lit("Centre "), (F.col("s_nationkey") % 3).cast("string")).alias("corp_centre"),
        )
    )
    fact = _sales(spark, sf_dir).select(
        "month_year", "week_start_date",
        _text("l_partkey").alias("global_sku_code"),
        _text("l_suppkey").alias("global_pos_code"),
        "pieces", "sales_rub",
    )
    networks = stores.select("global_pos_code", F.col("network_subname").alias("network_subname_alt"))
    return Star(fact, base_sku, stores, networks)


def coarse_star(spark: SparkSession, sf_dir: str) -> Star:
    """Product = brand, store = nation, network = region: dense enough for weekly prices."""
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    base_sku = part.select(
        F.col("p_brand").alias("global_sku_code"),
    ).distinct().select(
        "global_sku_code",
        F.concat(F.lit("Goods of "), "global_sku_code").alias("global_sku_name"),
        F.lit(1000.0).alias("weight"),
    )
    nation = table(spark, sf_dir, "nation")
    region = F.broadcast(table(spark, sf_dir, "region"))
    stores = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _text("n_nationkey").alias("global_pos_code"),
        F.col("r_name").alias("network_name"),
        F.col("r_name").alias("network_subname"),
    )
    products, suppliers = bounded_broadcast(
        part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("global_sku_code")),
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), _text("s_nationkey").alias("global_pos_code")),
    )
    fact = (
        _sales(spark, sf_dir)
        .join(products, "l_partkey")
        .join(suppliers, "l_suppkey")
        .select("month_year", "week_start_date", "global_sku_code", "global_pos_code", "pieces", "sales_rub")
    )
    networks = stores.select("global_pos_code", F.col("network_subname").alias("network_subname_alt"))
    return Star(fact, base_sku, stores, networks)
