"""Declared schemas of the sales star. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """`name type` pairs; a trailing `?` on the type marks a column that may be null."""
    fields = []
    for pair in text.split(","):
        name, kind = pair.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


# Column names, order, types and nullability of the star and of its raw partition files.
RETAIL_SALES = _schema(
    "month_year date, week_start_date date, network_name string, network_subname string, "
    "global_sku_code string, global_pos_code string, pieces int, sales_rub double"
)
CALENDAR = _schema(
    "week int, month int, year int, month_upr int, year_upr int, "
    "week_start_date date, week_end_date date, month_date date, month_upr_date date"
)
BASE_SKU = _schema(
    "global_sku_code string, network_name string, sku_code string, barcode string?, sku_name string, "
    "global_sku_name string, category string, segment string, group string, brand string, producer string, "
    "weight double, change timestamp?"
)
BASE_SALES_POINT = _schema(
    "global_pos_code string, network_name string, pos_code string, pos_name string, store_address string, "
    "store_format string, network_subname string, district string, region string, city string, change timestamp?"
)
RAW_PARTITION = _schema(
    "year int?, week int?, network_name string?, network_subname string?, sku_code string?, global_sku_code string?, "
    "pos_code string?, global_pos_code string?, pieces int?, sales_rub double?, alt_sku string?, "
    "week_start_date date?, month int?, file string?, created timestamp?, sheet string?, file_id int?, month_year date?"
)
ROLLUP = _schema(
    "report_date date, network_name string, network_subname string, category string?, segment string?, group string?, "
    "producer string?, brand string?, global_sku_name string?, weight double, level int, akb long, pieces long, "
    "kg double?, sales_rub double, last_update timestamp"
)

STAR = {
    "retail_sales": RETAIL_SALES,
    "calendar": CALENDAR,
    "base_sku": BASE_SKU,
    "base_sales_point": BASE_SALES_POINT,
}

# Key that must be unique in each dimension, or star joins multiply sales.
DIMENSION_KEYS = {
    "base_sku": ["global_sku_code"],
    "base_sales_point": ["global_pos_code"],
    "networks": ["global_pos_code"],
    "calendar": ["week_start_date"],
}

# Product hierarchy of the rollup, outermost first; a SKU row also carries brand, name and weight.
GROUP_KEYS = ["category", "segment", "group"]
SKU_KEYS = ["brand", "global_sku_name", "weight"]
ROW_KEYS = [*GROUP_KEYS, "producer", *SKU_KEYS]

# Report order of the four rollup levels.
TOTAL, GROUP, PRODUCER, SKU = 0, 1, 2, 3
