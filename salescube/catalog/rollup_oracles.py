"""Reference SQL of the load, check and rollup queries."""

from salescube.catalog.oracle_star import FINE, rollup_sql

_ROLLUP = f"WITH {FINE}, {rollup_sql()} SELECT * FROM rollup"
_FULL = """full_sales AS (
  SELECT month_year, week_start_date, network_name, network_subname, global_sku_code, global_pos_code, pieces,
         CAST(sales_rub AS double) AS sales_rub
  FROM retail_sales JOIN base_sales_point USING (global_pos_code))"""

_SPAN = """span AS (
  SELECT l_suppkey, CAST(min(l_shipdate) AS date) AS first_day, CAST(max(l_shipdate) AS date) AS last_day,
         CAST(count(DISTINCT date_trunc('week', l_shipdate)) AS integer) AS weeks
  FROM lineitem GROUP BY l_suppkey)"""


def _profile(name, table, key, required):
    missing = " OR ".join(f'"{c}" IS NULL' for c in required)
    return (
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {table}) AS row_count, "
        f"(SELECT count(*) FROM {table} WHERE {missing}) AS null_rows, "
        f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys, "
        f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS surplus_rows"
    )


def _renamed(sales: str) -> str:
    """The star with its sales under another name, for statements that change them."""
    return FINE.replace("retail_sales AS", f"{sales} AS", 1)


def _counts(period: str) -> str:
    """Distinct stores at the rollup's four levels, counted anew over the sales of each period."""
    dated = f"{_renamed('fine_sales')}, retail_sales AS (SELECT *, {period} AS period FROM fine_sales)"
    names = 'network_name, network_subname, category, segment, "group", producer, brand, global_sku_name, weight, level'
    return f"WITH {dated}, {rollup_sql(period='period')} SELECT report_date AS period, {names}, akb FROM rollup"


_GAPS = f"""{FINE}, lost AS (
  SELECT r.*, concat_ws(',', CASE WHEN p.global_sku_code IS NULL THEN 'product' END, CASE WHEN s.global_pos_code IS NULL THEN 'store' END,
                        CASE WHEN n.global_pos_code IS NULL THEN 'network' END) AS loss
  FROM retail_sales r
  LEFT JOIN base_sku p ON p.global_sku_code = r.global_sku_code AND weight <= 4000
  LEFT JOIN base_sales_point s ON s.global_pos_code = r.global_pos_code AND s.store_format <> 'wholesale'
  LEFT JOIN base_sales_point n ON n.global_pos_code = r.global_pos_code AND n.network_name <> 'ASIA')"""
_SUMS = "count(*) AS sales_rows, CAST(sum(pieces) AS bigint) AS pieces, CAST(sum(sales_rub) AS double) AS sales_rub"
_MATCHED = rollup_sql(where="p.weight <= 4000 AND n.store_format <> 'wholesale' AND n.network_name <> 'ASIA'")

ORACLES = {
    "join_losses": f"""WITH {_GAPS}
        SELECT month_year, coalesce(nullif(loss, ''), 'kept') AS loss, {_SUMS} FROM lost GROUP BY ALL""",
    "missing_codes": f"""WITH {_GAPS}, named AS (SELECT *, unnest(string_split(loss, ',')) AS dimension FROM lost WHERE loss <> '')
        SELECT dimension, CASE dimension WHEN 'product' THEN global_sku_code ELSE global_pos_code END AS code, {_SUMS}
        FROM named GROUP BY 1, 2""",
    "rollup_of_matched": f"WITH {FINE}, {_MATCHED} SELECT * FROM rollup",
    "rollup_grouping_sets": _ROLLUP,
    "slice_replace": _ROLLUP,
    "rollup_refresh": _ROLLUP,
    "slice_delete": f"{_ROLLUP} WHERE NOT (report_date = DATE '1995-03-01' AND network_name = 'ASIA')",
    "rollup_incremental": f"""WITH {_renamed('fine_sales')}, retail_sales AS (
          SELECT f.* REPLACE (CAST(pieces + CASE WHEN month_year = DATE '1995-03-01' AND network_name = 'ASIA' THEN 1 ELSE 0 END AS integer) AS pieces)
          FROM fine_sales f JOIN (SELECT global_pos_code AS code, network_name FROM base_sales_point) ON code = global_pos_code
          WHERE NOT (month_year = DATE '1995-04-01' AND network_name = 'ASIA')), {rollup_sql()}
        SELECT * FROM rollup""",
    "slice_versions": f"""WITH {FINE}, {rollup_sql()}, {rollup_sql(name="retail", where="n.store_format <> 'wholesale'")}
        SELECT *, 1 AS version FROM rollup WHERE report_date = DATE '1995-03-01' AND network_name = 'ASIA'
        UNION ALL SELECT *, 2 FROM retail WHERE report_date = DATE '1995-03-01' AND network_name = 'ASIA'""",
    "active_stores_monthly": _counts("month_year"),
    "active_stores_by_quarter": _counts("CAST(date_trunc('quarter', month_year) AS date)"),
    "active_stores_by_year": f"""WITH {FINE}
        SELECT CAST(date_trunc('year', month_year) AS date) AS period, network_name, category, producer, count(DISTINCT global_pos_code) AS akb
        FROM retail_sales JOIN base_sku USING (global_sku_code) JOIN base_sales_point USING (global_pos_code) GROUP BY ALL""",
    "active_stores_trailing": f"""WITH {FINE},
        sold AS (SELECT DISTINCT month_year, network_name, network_subname, global_pos_code FROM retail_sales JOIN base_sales_point USING (global_pos_code)),
        ends AS (SELECT DISTINCT month_year AS period FROM sold)
        SELECT period, network_name, network_subname, count(DISTINCT global_pos_code) AS akb
        FROM ends JOIN sold ON month_year BETWEEN period - INTERVAL 2 MONTH AND period GROUP BY ALL""",
    "snapshot_of_year": f"WITH {FINE}, {_FULL} SELECT * FROM full_sales WHERE year(month_year) = 1995",
    "views_sql": f"""WITH {FINE}
        SELECT CASE store_format WHEN 'wholesale' THEN store_format ELSE n.network_subname END AS place,
               CASE WHEN weight <= 1000 THEN 'light' WHEN weight <= 3000 THEN 'medium' END AS weight_category,
               count(*) AS row_count, CAST(sum(sales_rub) AS double) AS sales_rub
        FROM retail_sales JOIN base_sku USING (global_sku_code) JOIN base_sales_point n USING (global_pos_code)
        GROUP BY ALL""",
    "rollup_variant_filtered": f"""WITH {FINE}, {rollup_sql(where="n.store_format <> 'wholesale'")}
        SELECT * FROM rollup""",
    "rollup_variant_whole": f"WITH {FINE}, {rollup_sql(subname='n.network_name')} SELECT * FROM rollup",
    "rollup_variant_regrouped": f"WITH {FINE}, {rollup_sql(subname='n.corp_centre')} SELECT * FROM rollup",
    "slice_extract": f"""WITH {FINE}, {_FULL}
        SELECT month_year, global_sku_code, global_pos_code, pieces, sales_rub FROM full_sales
        WHERE month_year = DATE '1995-03-01' AND network_name = 'ASIA'""",
    "slice_counts": f"""WITH {FINE}, {_FULL}
        SELECT month_year, network_name, count(*) AS row_count FROM full_sales GROUP BY ALL""",
    "month_series": f"""WITH {_SPAN}
        SELECT l_suppkey, first_day, last_day, CAST(m AS date) AS report_date
        FROM (SELECT l_suppkey, first_day, last_day,
                     unnest(generate_series(date_trunc('month', first_day), CAST(last_day AS timestamp),
                                            INTERVAL 1 MONTH)) AS m
              FROM span)
        WHERE m >= first_day""",
    "week_series": f"""WITH {_SPAN}
        SELECT l_suppkey, first_day, weeks,
               CAST(first_day + CAST((8 - isodow(first_day)) % 7 AS integer) + 7 * CAST(i AS integer) AS date)
                   AS week_start_date
        FROM (SELECT l_suppkey, first_day, weeks, unnest(range(weeks)) AS i FROM span)""",
    "week_steps": f"""WITH {_SPAN}
        SELECT l_suppkey, first_day, last_day, CAST(first_day + 7 * CAST(i AS integer) AS date) AS week_start_date
        FROM (SELECT l_suppkey, first_day, last_day,
                     unnest(range(CAST((last_day - first_day) // 7 + 1 AS bigint))) AS i FROM span)""",
    "network_list": f"WITH {FINE}, {_FULL} SELECT DISTINCT network_subname FROM full_sales ORDER BY 1",
    "dim_checks": f"WITH {FINE} " + " UNION ALL ".join([
        _profile("retail_sales", "retail_sales", "week_start_date, global_sku_code, global_pos_code",
                 ["pieces", "sales_rub"]),
        _profile("base_sku", "base_sku", "global_sku_code", ["category", "group", "weight"]),
        _profile("base_sku_by_name", "base_sku", "global_sku_name", ["global_sku_name"]),
        _profile("base_sales_point", "base_sales_point", "global_pos_code", ["network_name"]),
        _profile("networks", "base_sales_point", "global_pos_code", ["network_subname"]),
    ]),
    "network_mismatch": """
        SELECT cr.r_name AS network_name, sr.r_name AS store_network, count(*) AS row_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
        WHERE cr.r_name <> sr.r_name GROUP BY ALL""",
    "sku_name_lookup": "SELECT p_brand AS global_sku_code, min(p_name) AS sku_name FROM part GROUP BY p_brand",
    "store_format_view": f"""WITH {FINE}
        SELECT global_pos_code,
               CASE store_format WHEN 'wholesale' THEN store_format ELSE network_subname END AS network_subname_alt
        FROM base_sales_point""",
    "weight_categories": f"""WITH {FINE}
        SELECT global_sku_code, weight,
               CASE WHEN weight <= 1000 THEN 'light' WHEN weight <= 3000 THEN 'medium' END AS weight_category
        FROM base_sku""",
    "snapshot_roundtrip": f"WITH {FINE}, {_FULL} SELECT * FROM full_sales",
    "zstd_roundtrip": f"WITH {FINE}, {_FULL} SELECT * FROM full_sales",
    "warehouse_sales": f"WITH {FINE}, {_FULL} SELECT * FROM full_sales",
    "warehouse_skus": f"""WITH {FINE}
        SELECT global_sku_code, 'any' AS network_name, 'K-' || global_sku_code AS sku_code,
               CAST(NULL AS varchar) AS barcode, global_sku_name AS sku_name, global_sku_name, category, segment,
               "group", brand, producer, weight, CAST(NULL AS timestamp) AS change
        FROM base_sku""",
    "warehouse_stores": f"""WITH {FINE}
        SELECT global_pos_code, network_name, 'S;' || global_pos_code AS pos_code,
               '"' || global_pos_code || '" store' AS pos_name, 'address' AS store_address, store_format,
               network_subname, 'district' AS district, network_name AS region, 'city' AS city,
               CAST(NULL AS timestamp) AS change
        FROM base_sales_point""",
    "warehouse_calendar": f"""WITH {FINE}, w AS (SELECT DISTINCT week_start_date FROM retail_sales)
        SELECT CAST(week(week_start_date) AS integer) AS week, CAST(month(week_start_date) AS integer) AS "month",
               CAST(year(week_start_date) AS integer) AS "year",
               CAST(month(week_start_date + 3) AS integer) AS month_upr,
               CAST(year(week_start_date + 3) AS integer) AS year_upr,
               week_start_date, week_start_date + 6 AS week_end_date,
               CAST(date_trunc('month', week_start_date) AS date) AS month_date,
               CAST(date_trunc('month', week_start_date + 3) AS date) AS month_upr_date
        FROM w""",
    "partition_list": f"""WITH {FINE}
        SELECT DISTINCT month_year,
               'retail_sales_y' || year(month_year) || 'm' || month(month_year) || '_2024-01-10.zst' AS file_name,
               CAST(year(month_year) * 100 + month(month_year) AS integer) AS partition_number
        FROM retail_sales ORDER BY month_year""",
    "partition_latest": f"""WITH {FINE}
        SELECT month_year, week_start_date, global_sku_code, global_pos_code, pieces,
               CAST(sales_rub AS double) AS sales_rub
        FROM retail_sales WHERE month_year = (SELECT max(month_year) FROM retail_sales)""",
}

ORACLES["zstd_stores"] = ORACLES["warehouse_stores"]
