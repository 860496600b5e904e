"""The star mapping as SQL text, shared by the reference SQL."""

FINE = """
retail_sales AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS date) AS month_year,
         CAST(date_trunc('week', l_shipdate) AS date) AS week_start_date,
         CAST(l_partkey AS varchar) AS global_sku_code, CAST(l_suppkey AS varchar) AS global_pos_code,
         CAST(l_quantity AS integer) AS pieces,
         CAST(l_extendedprice * (1 - l_discount) AS decimal(18,4)) AS sales_rub
  FROM lineitem),
base_sku AS (
  SELECT CAST(p_partkey AS varchar) AS global_sku_code, p_type AS category,
         split_part(p_name, ' ', 1) AS segment, split_part(p_name, ' ', 2) AS "group", p_brand AS brand,
         'Producer ' || CAST(CAST(substr(p_brand, 7) AS integer) % 5 AS varchar) AS producer,
         p_name AS global_sku_name, CAST(p_size * 100 AS double) AS weight
  FROM part),
base_sales_point AS (
  SELECT CAST(s_suppkey AS varchar) AS global_pos_code, r_name AS network_name, n_name AS network_subname,
         CASE WHEN s_acctbal < 0 THEN 'wholesale' ELSE 'retail' END AS store_format,
         'Centre ' || CAST(s_nationkey % 3 AS varchar) AS corp_centre
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""

COARSE = """
retail_sales AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS date) AS month_year,
         CAST(date_trunc('week', l_shipdate) AS date) AS week_start_date,
         p_brand AS global_sku_code, CAST(s_nationkey AS varchar) AS global_pos_code,
         CAST(l_quantity AS integer) AS pieces,
         CAST(l_extendedprice * (1 - l_discount) AS decimal(18,4)) AS sales_rub
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
base_sku AS (
  SELECT DISTINCT p_brand AS global_sku_code, 'Goods of ' || p_brand AS global_sku_name, 1000.0::double AS weight
  FROM part),
networks AS (
  SELECT CAST(n_nationkey AS varchar) AS global_pos_code, r_name AS network_subname_alt
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


def rollup_sql(name="rollup", subname="n.network_subname", where="TRUE", period="month_year"):
    """CTE of the rollup: four aggregates stacked, one per level."""
    product = ["category", "segment", "group", "producer", "brand", "global_sku_name"]
    levels = {3: 6, 2: 4, 1: 3, 0: 0}
    parts = []
    for level, kept in levels.items():
        shown = [f'"{c}"' if i < kept else f'CAST(NULL AS varchar) AS "{c}"' for i, c in enumerate(product)]
        weight = "weight" if level == 3 else "CAST(0 AS double) AS weight"
        keys = ["report_date", "network_name", "network_subname", *[f'"{c}"' for c in product[:kept]]]
        keys += ["weight"] if level == 3 else []
        parts.append(
            f"SELECT report_date, network_name, network_subname, {', '.join(shown)}, {weight}, {level} AS level, "
            "count(DISTINCT global_pos_code) AS akb, CAST(sum(pieces) AS bigint) AS pieces, "
            "round_even(CAST(sum(pieces * CAST(w AS decimal(18,4))) AS double) / 1000, 2) AS kg, "
            "round_even(CAST(sum(sales_rub) AS double), 2) AS sales_rub "
            f"FROM {name}_rows GROUP BY {', '.join(keys)}"
        )
    return (
        f"{name}_rows AS (SELECT r.{period} AS report_date, n.network_name, {subname} AS network_subname, "
        'p.category, p.segment, p."group", p.producer, p.brand, p.global_sku_name, coalesce(p.weight, 0) AS weight, '
        "p.weight AS w, r.global_pos_code, r.pieces, r.sales_rub "
        "FROM retail_sales r JOIN base_sku p ON p.global_sku_code = r.global_sku_code "
        f"JOIN base_sales_point n ON n.global_pos_code = r.global_pos_code WHERE {where}),\n"
        f"{name} AS ({' UNION ALL '.join(parts)})"
    )
