"""Reference SQL of the elasticity queries."""

from salescube.catalog.oracle_star import COARSE

_W = 500


def _study(width, window=None):
    """CTEs of the study: over all weeks or, copied into every window of `window` weeks, by the window's first week."""
    sold, weeks = ("sw", "(SELECT weeks FROM span)") if window is None else ("once", window)
    windows = "" if window is None else f"""starts AS (
  SELECT CAST(unnest(generate_series(first_week, last_week - {7 * (window - 1)}, INTERVAL 7 DAY)) AS date) AS window_start
  FROM span),
sw AS (SELECT * FROM starts JOIN once ON week_start_date BETWEEN window_start AND window_start + {7 * (window - 1)}),
"""

    def start(table):
        return "" if window is None else f"{table}.window_start, "

    key = f"{'' if window is None else 'window_start, '}network_subname, global_sku_code"
    return f"""{COARSE},
span AS (
  SELECT min(week_start_date) AS first_week, max(week_start_date) AS last_week,
         (max(week_start_date) - min(week_start_date)) // 7 + 1 AS weeks
  FROM retail_sales),
{sold} AS (
  SELECT m.network_subname_alt AS network_subname, r.global_sku_code, r.week_start_date, r.global_pos_code,
         CAST(week(r.week_start_date) AS integer) AS wk_num,
         CAST(sum(r.pieces * CAST(p.weight AS decimal(18,4))) * 0.001 AS decimal(28,7)) AS kg,
         sum(r.sales_rub) AS rub
  FROM retail_sales r JOIN base_sku p ON p.global_sku_code = r.global_sku_code
  JOIN networks m ON m.global_pos_code = r.global_pos_code
  GROUP BY ALL),
{windows}weekly AS (
  SELECT *, CAST(rub AS double) / nullif(CAST(kg AS double), 0) AS price_kg,
         floor(CAST(rub AS double) / nullif(CAST(kg AS double), 0) / {width}) * {width} AS price_bin
  FROM sw),
stores AS (
  SELECT {key}, global_pos_code, count(*) AS wks,
         string_agg(CAST(wk_num AS varchar), ';' ORDER BY week_start_date) AS wks_list,
         sum(kg) AS kg, sum(rub) AS rub,
         CASE WHEN count(*) > floor(0.25 * {weeks}) THEN 1 ELSE 0 END AS filter
  FROM weekly GROUP BY {key}, global_pos_code),
flagged AS (
  SELECT w.*, s.wks, s.filter,
         CAST(CAST(w.price_bin AS bigint) AS varchar) || '-' || CAST(CAST(w.price_bin + {width} AS bigint) AS varchar)
             AS price_bin_range
  FROM weekly w JOIN stores s USING ({key}, global_pos_code)),
totals AS (
  SELECT {key}, sum(kg) AS listed_kg, count(*) AS listed_stores,
         sum(filter) AS kept_stores, sum(filter * wks) AS kept_rows
  FROM stores GROUP BY ALL),
levels AS (
  SELECT {start("f")}f.network_subname, f.global_sku_code, f.price_bin, f.price_bin_range,
         CAST(sum(f.kg) FILTER (WHERE f.filter = 1) AS double) AS kg,
         count(*) FILTER (WHERE f.filter = 1) AS akb,
         CAST(t.listed_kg AS double) AS listed_kg, CAST(t.listed_stores AS bigint) AS listed_stores,
         CAST(t.kept_stores AS bigint) AS kept_stores, CAST(t.kept_rows AS bigint) AS kept_rows
  FROM flagged f JOIN totals t USING ({key})
  GROUP BY ALL),
limited AS (
  SELECT *, round_even(kg / nullif(akb, 0), 4) AS turnover,
         CAST(round_even(0.01::double * listed_stores * {weeks}, 0) AS bigint) AS akb_limit
  FROM levels),
covered AS (
  SELECT *, CASE WHEN akb >= akb_limit AND akb > 0 AND price_bin IS NOT NULL THEN 1 ELSE 0 END AS filter FROM limited),
points AS (SELECT * EXCLUDE (price_bin), price_bin + {width} / 2 AS price_bin FROM covered WHERE filter = 1),
means AS (
  SELECT {key}, count(*) AS points,
         sum(akb * ln(price_bin)) / sum(akb) AS mx, sum(akb * ln(turnover)) / sum(akb) AS my,
         sum(akb * turnover) / sum(akb) AS mean_turnover
  FROM points GROUP BY ALL),
lines AS (
  SELECT m.*, b.slope, m.my - b.slope * m.mx AS intercept
  FROM means m JOIN (
    SELECT {key},
           CASE WHEN min(price_bin) < max(price_bin) THEN
             sum(akb * (ln(price_bin) - mx) * (ln(turnover) - my)) / sum(akb * (ln(price_bin) - mx) ** 2) END AS slope
    FROM points JOIN means USING ({key})
    GROUP BY {key}) b USING ({key})),
predicted AS (
  SELECT p.*, l.slope, l.intercept, l.mean_turnover, l.points,
         exp(l.intercept + l.slope * ln(p.price_bin)) AS fitted
  FROM points p JOIN lines l USING ({key})),
pair_fits AS (
  SELECT {key}, any_value(points) AS points, any_value(slope) AS slope,
         any_value(intercept) AS intercept, sum(kg) AS covered_kg,
         CASE WHEN any_value(slope) IS NULL THEN 'too_few_points' ELSE 'ok' END AS status,
         round_even(any_value(slope), 4) AS ped, round_even(any_value(intercept), 4) AS alpha,
         round_even(1 - sum(akb * (turnover - fitted) ** 2) / nullif(sum(akb * (turnover - mean_turnover) ** 2), 0), 4)
             AS r2,
         round_even(sqrt(sum(akb * (turnover - fitted) ** 2) / sum(akb)), 4) AS rmse
  FROM predicted GROUP BY {key}),
left_out AS (
  SELECT {key}, count(*) AS points_left_out FROM covered
  WHERE filter = 1 AND turnover <= 0 GROUP BY ALL),
fits AS (
  SELECT {start("t")}t.network_subname, t.global_sku_code, coalesce(points, 0) AS points, coalesce(points_left_out, 0) AS points_left_out,
         slope, intercept, coalesce(covered_kg, 0) AS covered_kg, coalesce(status, 'no_points') AS status, ped, alpha, r2, rmse,
         CAST(listed_kg AS double) AS listed_kg, CAST(listed_stores AS bigint) AS listed_stores,
         CAST(kept_stores AS bigint) AS kept_stores, CAST(kept_rows AS bigint) AS kept_rows
  FROM totals t LEFT JOIN pair_fits USING ({key})
  LEFT JOIN left_out USING ({key}))
"""


_BASE = _study(_W)

_WEEKLY = (
    "network_subname, global_sku_code, wk_num, week_start_date, global_pos_code, CAST(kg AS double) AS kg, "
    "CAST(rub AS double) AS rub, price_kg, price_bin"
)
_POINT = "network_subname, global_sku_code, price_bin, price_bin_range, kg, akb, turnover"
_KEPT = "(SELECT network_subname, global_sku_code, global_pos_code FROM stores WHERE filter = 1)"
_STORE = "(network_subname, global_sku_code, global_pos_code)"
_KEPT_LIMIT = "round(0.0067 * (SELECT weeks FROM span) * kept_stores, 0)"

ORACLES = {
    "store_week_prices": f"WITH {_BASE} SELECT {_WEEKLY} FROM weekly",
    "store_activity": f"""WITH {_BASE}
        SELECT * REPLACE (CAST(kg AS double) AS kg, CAST(rub AS double) AS rub) FROM stores""",
    "store_kept_flag": f"""WITH {_BASE}
        SELECT network_subname, global_sku_code, wk_num, week_start_date, global_pos_code, CAST(kg AS double) AS kg,
               CAST(rub AS double) AS rub, price_bin_range, wks, filter,
               week_start_date = min(week_start_date) OVER (
                   PARTITION BY network_subname, global_sku_code, global_pos_code) AS first_of_store
        FROM flagged""",
    "semi_join_kept_stores": f"WITH {_BASE} SELECT {_WEEKLY} FROM weekly WHERE {_STORE} IN {_KEPT}",
    "anti_join_dropped_stores": f"WITH {_BASE} SELECT {_WEEKLY} FROM weekly WHERE {_STORE} NOT IN {_KEPT}",
    "price_bins_weekly": f"""WITH {_BASE}
        SELECT network_subname, global_sku_code, wk_num, week_start_date, round_even(price_kg, 2) AS price_kg, price_bin,
               price_bin_range, CAST(sum(kg) AS double) / count(*) AS turnover, CAST(sum(kg) AS double) AS kg,
               count(*) AS akb
        FROM flagged WHERE filter = 1 AND price_bin IS NOT NULL
        GROUP BY network_subname, global_sku_code, wk_num, week_start_date, round_even(price_kg, 2), price_bin,
                 price_bin_range""",
    "price_levels": f"WITH {_BASE} SELECT * FROM covered WHERE akb > 0 AND price_bin IS NOT NULL",
    "price_points": f"WITH {_BASE} SELECT {_POINT} FROM points",
    "price_points_kept_base": f"""WITH {_BASE}
        SELECT {_POINT.replace('price_bin,', f'price_bin + {_W} / 2 AS price_bin,', 1)} FROM limited
        WHERE akb >= {_KEPT_LIMIT} AND akb > 0 AND price_bin IS NOT NULL""",
    "price_points_sql": f"""WITH {_BASE}
        SELECT network_subname, global_sku_code, price_bin + {_W} / 2 AS price_bin, price_bin_range, kg, akb,
               kg / akb AS turnover
        FROM levels WHERE akb >= {_KEPT_LIMIT} AND akb > 0 AND price_bin IS NOT NULL
        ORDER BY network_subname, global_sku_code, price_bin""",
    "ped_fit": f"""WITH {_BASE}
        SELECT network_subname, global_sku_code, status, points, points_left_out, ped, alpha, r2,
               rmse, covered_kg, listed_kg, listed_stores, kept_stores, kept_rows
        FROM fits""",
    "ped_predictions": f"WITH {_BASE} SELECT {_POINT}, round_even(fitted, 4) AS turnover_pred FROM predicted",
    "ped_summary": f"""WITH {_BASE}
        SELECT f.network_subname, f.global_sku_code, b.global_sku_name || ' (' || f.global_sku_code || ')' AS sku,
               strftime(first_week, '%Y.%m.%d') || '-' || strftime(last_week, '%Y.%m.%d') AS dates,
               format('{{:,d}}', weeks) AS weeks,
               format('{{:,d}} / {{:,d}}', kept_stores, listed_stores) AS stores,
               format('{{:,d}} / {{:,d}} / {{:,d}}', kept_rows, kept_stores * weeks, listed_stores * weeks) AS store_weeks,
               format('{{:,.0f}} / {{:,.0f}}', covered_kg, listed_kg) AS kg,
               format('{{:+.4f}}*ln(x) {{:+.4f}}', slope, intercept) AS log_equation,
               format('exp({{:+.4f}}*ln(x) {{:+.4f}})', slope, intercept) AS equation,
               status, ped, alpha, r2, rmse
        FROM fits f JOIN base_sku b USING (global_sku_code), span""",
}

_CHOSEN = "WHERE global_sku_code IN ('Brand#11', 'Brand#23') AND network_subname IN ('ASIA', 'EUROPE')"
ORACLES |= {
    "study_store_list": ORACLES["store_activity"],
    "study_store_weeks": f"SELECT * EXCLUDE (first_of_store) FROM ({ORACLES['store_kept_flag']})",
    "study_weekly_prices": ORACLES["price_bins_weekly"],
    "study_price_levels": ORACLES["price_levels"],
    "study_price_points": ORACLES["ped_predictions"],
    "study_results": ORACLES["ped_summary"],
    "study_of_products": f"SELECT * FROM ({ORACLES['ped_predictions']}) {_CHOSEN}",
    "price_points_sql_of_products": f"SELECT * FROM ({ORACLES['price_points_sql']}) {_CHOSEN}",
}

_GROUPS = [("network_subname", "global_sku_code"), ("CAST(NULL AS varchar)", "global_sku_code"),
           ("network_subname", "CAST(NULL AS varchar)"), ("CAST(NULL AS varchar)", "CAST(NULL AS varchar)")]
ORACLES["ped_merged"] = f"""WITH {_BASE},
logs AS (SELECT *, ln(price_bin) AS x, ln(turnover) AS y FROM points WHERE turnover > 0),
grouped AS ({" UNION ALL ".join(
    f"SELECT {i} AS scope, {n} AS network_subname, {s} AS global_sku_code, x, y, akb FROM logs" for i, (n, s) in enumerate(_GROUPS))}),
averages AS (
  SELECT scope, network_subname, global_sku_code, sum(akb * x) / sum(akb) AS mx, sum(akb * y) / sum(akb) AS my
  FROM grouped GROUP BY ALL),
centred AS (
  SELECT g.*, a.mx, a.my FROM grouped g JOIN averages a ON g.scope = a.scope
  AND g.network_subname IS NOT DISTINCT FROM a.network_subname AND g.global_sku_code IS NOT DISTINCT FROM a.global_sku_code),
sloped AS (
  SELECT scope, network_subname, global_sku_code, any_value(mx) AS mx, any_value(my) AS my,
         CASE WHEN min(x) < max(x) THEN sum(akb * (x - mx) * (y - my)) / sum(akb * (x - mx) ** 2) END AS slope
  FROM centred GROUP BY scope, network_subname, global_sku_code)
SELECT g.network_subname, g.global_sku_code, count(*) AS points, round_even(any_value(s.slope), 4) AS ped,
       round_even(any_value(s.my - s.slope * s.mx), 4) AS alpha,
       round_even(1 - sum(akb * (y - s.my - s.slope * (x - s.mx)) ** 2) / nullif(sum(akb * (y - s.my) ** 2), 0), 4) AS r2_log,
       round_even(sqrt(sum(akb * (y - s.my - s.slope * (x - s.mx)) ** 2) / sum(akb)), 4) AS rmse_log
FROM grouped g JOIN sloped s ON g.scope = s.scope
AND g.network_subname IS NOT DISTINCT FROM s.network_subname AND g.global_sku_code IS NOT DISTINCT FROM s.global_sku_code
GROUP BY g.scope, g.network_subname, g.global_sku_code"""


_WINDOWS = _study(5000, 104)
ORACLES["ped_by_window"] = f"""WITH {_WINDOWS}
SELECT window_start, network_subname, global_sku_code, status, points, points_left_out, ped, alpha, r2,
       rmse, covered_kg, listed_kg, listed_stores, kept_stores, kept_rows
FROM fits"""
ORACLES["kept_store_spans"] = f"""WITH {_WINDOWS},
numbered AS (
  SELECT *, window_start - CAST(7 * row_number() OVER (
           PARTITION BY network_subname, global_sku_code, global_pos_code ORDER BY window_start) AS integer) AS run
  FROM stores WHERE filter = 1)
SELECT network_subname, global_sku_code, global_pos_code, min(window_start) AS first_start, max(window_start) AS last_start
FROM numbered GROUP BY network_subname, global_sku_code, global_pos_code, run"""
