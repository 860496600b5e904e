"""Queries of the sales report and the databook."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.catalog.rollup_queries import build_rollup, stored_rollup
from salescube.catalog.star import fine_star, table
from salescube.functions.dates import (
    day_span, iso_week_label, monday_on_or_after, month_on_or_after, month_title, parse_day_column,
)
from salescube.functions.measures import as_doubles
from salescube.operators.star import fold_sales
from salescube.plans import databook, report
from salescube.sources.scratch import new_path, stage
from salescube.sources.tables import write_results

OWN_PRODUCER = "Producer 2"


def weekly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup by week, under names that mark its networks as weekly."""
    star = fine_star(spark, sf_dir)
    star.fact = star.fact.withColumn("month_year", F.col("week_start_date"))
    names = star.networks.withColumn(
        "network_subname_alt", F.concat(F.col("network_subname_alt"), F.lit(" ("), F.lit(report.WEEKLY_MARK), F.lit(")"))
    )
    star.networks = names
    return stage(build_rollup(star), "rollup-weekly")


def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cells(stored_rollup(spark, sf_dir))


def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.header(stored_rollup(spark, sf_dir))


def report_header_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.header(weekly_rollup(spark, sf_dir))


def trailing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(report.rows(stored_rollup(spark, sf_dir)))


def trailing_sales_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(report.rows(weekly_rollup(spark, sf_dir)))


def producer_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = report.producer_tail(report.rows(stored_rollup(spark, sf_dir)))
    return as_doubles(tail.drop("sales_all", "label", "brand", "global_sku_name", "weight", "level"))


def pruned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows after pruning, groups told apart by their whole path."""
    rows = report.rows(stored_rollup(spark, sf_dir))
    return as_doubles(report.pruned(rows, share=0.05, by=("category", "segment", "group")))


def minor_sku_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.rows(stored_rollup(spark, sf_dir))
    return as_doubles(report.marked(rows, OWN_PRODUCER, own_limit=20000))


def report_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(report.rows(stored_rollup(spark, sf_dir)), "report-rows")
    kept = stage(report.pruned(rows), "report-kept")
    return as_doubles(report.numbered(kept).drop("sales_all"))


def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = stored_rollup(spark, sf_dir)
    return report.pivoted(report.cells(rollup), report.period_list(rollup))


def sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished report of all networks, written and read back."""
    finished = as_doubles(report.build(stored_rollup(spark, sf_dir), OWN_PRODUCER))
    path = new_path(spark, "report")
    report.write(finished, path)
    return spark.read.schema(finished.schema).parquet(path)


def report_of_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of one network, chosen in the stored rollup before any work, over the periods that all networks have together."""
    rollup = stored_rollup(spark, sf_dir)
    chosen = rollup.where(F.col("network_subname") == "NATION_12")
    return as_doubles(report.build(chosen, OWN_PRODUCER, report.period_list(rollup)))


def printed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished report under its printed column names."""
    rollup = stored_rollup(spark, sf_dir)
    periods = report.period_list(rollup)
    return report.labelled(report.build(rollup, OWN_PRODUCER, periods), periods)


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of sales written as DD.MM.YYYY and parsed back, with its month title and the span of its week."""
    day = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct()
    parsed = day.select(F.date_format("day", "dd.MM.yyyy").alias("written")).withColumn("day", parse_day_column("written"))
    monday = monday_on_or_after(F.col("day"))
    return parsed.select(
        "written", "day", month_title("day").alias("month_title"), month_on_or_after(F.col("day")).alias("next_month"),
        day_span(F.col("day"), monday).alias("span"),
    )


def iso_week_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fine_star(spark, sf_dir).fact
    return as_doubles(
        fold_sales(fact, "week_start_date").withColumn("week_label", iso_week_label("week_start_date"))
    )


def databook_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roubles by category, producer and month."""
    star = fine_star(spark, sf_dir)
    folded = fold_sales(star.fact, "month_year", "global_sku_code")
    products = star.base_sku.select("global_sku_code", "category", "producer")
    joined = folded.join(products, "global_sku_code")
    return databook.measure_by_period(joined, KEYS, "month_year", F.sum("sales_rub"))


KEYS = ["category", "producer"]
SECTION = {
    "m_on_m": ("m_on_m", "sum", "abs_change"),
    "y_on_y": ("m_on_m_last_year", "sum", "pct_change"),
    "ytd": ("ytd_on_ytd", "mean", "pp_change"),
}


def current_month(spark: SparkSession, sf_dir: str) -> date:
    return fine_star(spark, sf_dir).fact.agg(F.max("month_year")).first()[0]


def _changes(period: str, aggregate: str = "sum"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        current = current_month(spark, sf_dir)
        compared = databook.changes(databook_source(spark, sf_dir), KEYS, current, period, aggregate)
        return as_doubles(compared)

    return query


def totals_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(databook.with_totals(databook_source(spark, sf_dir), KEYS))


def change_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three text forms of the change on the month before."""
    current = current_month(spark, sf_dir)
    shown = databook.changes(databook_source(spark, sf_dir), KEYS, current)
    for form in ("abs_change", "pp_change", "pct_change"):
        shown = databook.formatted(shown, form, form)
    return shown.drop("previous", "current", "change")


def databook_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished section: months, three changes as text, totals row."""
    return databook.table(
        databook_source(spark, sf_dir),
        KEYS,
        current_month(spark, sf_dir),
        SECTION,
    )


def databook_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section as a job: its source rows and its finished table are saved, and the table is built from the saved copy."""
    root = new_path(spark, "databook")
    source = databook_source(spark, sf_dir)
    write_results({"source": source}, root)
    saved = spark.read.schema(source.schema).parquet(f"{root}/source")
    table = databook.table(saved, KEYS, current_month(spark, sf_dir), SECTION)
    write_results({"table": table}, root)
    return spark.read.schema(table.schema).parquet(f"{root}/table")


QUERIES = {
    "derived_metrics": derived_metrics,
    "report_header": report_header,
    "report_header_weekly": report_header_weekly,
    "trailing_sales": trailing_sales,
    "trailing_sales_weekly": trailing_sales_weekly,
    "producer_pruning": producer_pruning,
    "pruned_rows": pruned_rows,
    "minor_sku_flags": minor_sku_flags,
    "report_numbering": report_numbering,
    "report_pivot": report_pivot,
    "sales_report": sales_report,
    "printed_report": printed_report,
    "date_texts": date_texts,
    "iso_week_labels": iso_week_labels,
    "totals_row": totals_row,
    "change_mom": _changes("m_on_m"),
    "change_yoy": _changes("m_on_m_last_year"),
    "change_ytd_sum": _changes("ytd_on_ytd", "sum"),
    "change_ytd_mean": _changes("ytd_on_ytd", "mean"),
    "change_formatted": change_formatted,
    "databook_table": databook_table,
    "databook_saved": databook_saved,
    "report_of_network": report_of_network,
}
