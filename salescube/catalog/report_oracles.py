"""Reference SQL of the report and databook queries."""

from datetime import date

from salescube.catalog.oracle_star import FINE, rollup_sql

# Months of the given tables; the last one is the databook's current month.
FIRST, LAST = date(1995, 1, 1), date(2001, 11, 1)
MONTHS = [date(n // 12, n % 12 + 1, 1) for n in range(FIRST.year * 12 + FIRST.month - 1, LAST.year * 12 + LAST.month)]
METRICS = ["akb", "pieces_per_store", "rub_per_store", "pieces", "kg", "price_piece", "price_kg", "sales_rub"]

_ROW = 'network_subname, category, segment, "group", brand, producer, global_sku_name, weight, level'
_SORT = """category NULLS FIRST, segment NULLS FIRST, "group" NULLS FIRST, level, sales_3m DESC, sales_all DESC,
           label NULLS FIRST, producer NULLS FIRST, brand NULLS FIRST, weight"""
_RU = ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь", "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"]


def _month_name(column):
    names = ", ".join(f"'{m}'" for m in _RU)
    return f"[{names}][month({column})] || ' ' || year({column})"


_CELLS = f"""cells AS (
  SELECT {_ROW}, report_date AS period,
         round_even(max(CAST(akb AS double)), 2) AS akb,
         round_even(max(pieces / nullif(akb, 0)), 2) AS pieces_per_store,
         round_even(max(sales_rub / nullif(akb, 0)), 2) AS rub_per_store,
         round_even(max(CAST(pieces AS double)), 2) AS pieces,
         round_even(max(kg), 2) AS kg,
         round_even(max(sales_rub / nullif(pieces, 0)), 2) AS price_piece,
         round_even(max(CASE WHEN kg = 0 AND sales_rub > 0 THEN 0 ELSE sales_rub / nullif(kg, 0) END), 2) AS price_kg,
         round_even(max(sales_rub), 2) AS sales_rub
  FROM rollup GROUP BY ALL)"""


def _spans(trailing):
    return f"""spans AS (
  SELECT network_subname, min(report_date) AS first_period, max(report_date) AS last_period,
         CAST(max(report_date) - INTERVAL {trailing} AS date) AS trailing_start
  FROM rollup GROUP BY network_subname)"""


_ROWS = f"""report_rows AS (
  SELECT {', '.join('c.' + k.strip() for k in _ROW.split(','))},
         coalesce(sum(CAST(sales_rub AS decimal(18,2))) FILTER (WHERE period BETWEEN trailing_start AND last_period), 0)
             AS sales_3m,
         sum(CAST(sales_rub AS decimal(18,2))) AS sales_all,
         CASE level WHEN 0 THEN 'Общий итог' WHEN 1 THEN "group" WHEN 2 THEN producer ELSE global_sku_name END AS label
  FROM cells c JOIN spans USING (network_subname)
  GROUP BY ALL)"""

_MONTHLY = f"{FINE}, {rollup_sql()}, {_CELLS}, {_spans('2 MONTH')}, {_ROWS}"
_WEEKLY_NAME = "n.network_subname || ' (понед.)'"
_WEEKLY = (
    f"{FINE}, {rollup_sql(subname=_WEEKLY_NAME, period='week_start_date')}, {_CELLS}, {_spans('12 WEEK')}, {_ROWS}"
)


def _tail(share, keys):
    rest = [k for k in ("category", "segment", '"group"', "producer") if k not in keys]
    by = ", ".join(["network_subname", *keys])
    order = ", ".join(f"{k} NULLS FIRST" for k in rest)
    return f"""tail AS (
  SELECT *, running_sales_3m >= CAST({share} AS decimal(6,4)) * group_sales_3m AS is_top
  FROM (SELECT *, sum(sales_3m) OVER (PARTITION BY {by}) AS group_sales_3m,
               sum(sales_3m) OVER (PARTITION BY {by} ORDER BY sales_3m, {order} ROWS UNBOUNDED PRECEDING)
                   AS running_sales_3m
        FROM report_rows WHERE level = 2)),
kept_rows AS (
  SELECT * FROM report_rows WHERE level <> 2
  UNION ALL SELECT * EXCLUDE (group_sales_3m, running_sales_3m, is_top) FROM tail WHERE is_top)"""


def _roman(number):
    """Thousands, hundreds, tens and the rest."""
    hundreds = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
    tens = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
    shown = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return (f"repeat('M', CAST({number} // 1000 AS integer)) || {shown(hundreds)}[{number} // 100 % 10 + 1] || "
            f"{shown(tens)}[{number} // 10 % 10 + 1] || {shown(ones)}[{number} % 10 + 1]")


_NUMBERED = f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY network_subname ORDER BY {_SORT}) AS position,
         row_number() OVER (PARTITION BY network_subname, category, segment, "group", level ORDER BY {_SORT}) AS n
  FROM kept_rows),
numbered AS (
  SELECT * EXCLUDE (n),
         CASE level WHEN 3 THEN CAST(n AS varchar) WHEN 2 THEN {_roman('n')} END AS number
  FROM placed)"""


def _marked(source, limit):
    return f"""marked AS (
  SELECT r.*, coalesce(g.sales_3m, 0) AS group_sales_3m,
         r.level = 3 AND coalesce(
             CASE WHEN r.producer = 'Producer 2' THEN r.sales_3m < {limit} ELSE r.sales_3m < 0.01 * g.sales_3m END, false)
             AS is_minor,
         r.level = 3 AND coalesce(r.producer = 'Producer 2', false) AS is_own
  FROM {source} r LEFT JOIN (SELECT * FROM report_rows WHERE level = 1) g
    ON r.network_subname = g.network_subname AND r.category IS NOT DISTINCT FROM g.category
   AND r.segment IS NOT DISTINCT FROM g.segment AND r."group" IS NOT DISTINCT FROM g."group")"""


_MONEY = "CAST(sales_3m AS double) AS sales_3m"
_ALL = "CAST(sales_all AS double) AS sales_all"
_GROUP = "CAST(group_sales_3m AS double) AS group_sales_3m"
_TOP = _tail("0.01", ['"group"'])

_WIDE = ", ".join(
    f"max({m}) FILTER (WHERE period = DATE '{p}') AS \"{m}_{p}\"" for m in METRICS for p in MONTHS
)
_TEXT = ["category", "segment", '"group"', "brand", "producer", "global_sku_name", "label", "number"]

_HEADER = f"""SELECT network_subname, first_period, last_period, CASE WHEN network_subname LIKE '%понед.%' THEN 'Неделя' ELSE 'Месяц' END AS frequency, trailing_start,
       'Динамика основных показателей по продажам в ' || network_subname AS title,
       {_month_name('first_period')} || ' - ' || {_month_name('last_period')} AS dates
FROM spans"""

_BOOK = f"""{FINE},
book AS (
  SELECT category, producer, month_year AS period, sum(sales_rub) AS value
  FROM retail_sales JOIN base_sku USING (global_sku_code) GROUP BY ALL)"""
_NOW = f"DATE '{LAST}'"


def _pair(period, aggregate="sum"):
    if period == "ytd_on_ytd":
        parts = [f"FILTER (WHERE year(period) = {y} AND month(period) <= {LAST.month})" for y in (LAST.year - 1, LAST.year)]
        if aggregate == "mean":
            return [f"CAST(sum(value) {p} AS double) / count(value) {p}" for p in parts]
        return [f"coalesce(CAST(sum(value) {p} AS double), 0)" for p in parts]
    earlier = date(LAST.year, LAST.month - 1, 1) if period == "m_on_m" else date(LAST.year - 1, LAST.month, 1)
    return [f"CAST(sum(value) FILTER (WHERE period = DATE '{p}') AS double)" for p in (earlier, LAST)]


def _change(period, aggregate="sum"):
    previous, current = _pair(period, aggregate)
    return f"""WITH {_BOOK},
        sides AS (SELECT category, producer, {previous} AS previous, {current} AS current
                  FROM book WHERE period BETWEEN DATE '{LAST.year - 1}-01-01' AND {_NOW} GROUP BY category, producer)
        SELECT *, current - previous AS change FROM sides"""


def _shown(form, p, c):
    """The printed text of a change; a negative zero loses its sign, a missing value is a dash."""
    if form == "pct_change":
        times = f"({c} / nullif({p}, 0))"
        text = (
            f"CASE WHEN {times} - 1 > 1.5 THEN replace(format('{{:.1f}}', {times}), '.', ',') || 'x' "
            f"ELSE format('{{:.0f}}%', ({times} - 1) * 100) END"
        )
        missing = f"{times} IS NULL"
    else:
        places = 0 if form == "abs_change" else 1
        text = f"translate(format('{{:,.{places}f}}', {c} - {p}), ',.', ' ,')"
        missing = f"{c} - {p} IS NULL"
    return (
        f"CASE WHEN {missing} THEN '–' ELSE CASE {text} WHEN '-0%' THEN '0%' WHEN '-0' THEN '0' "
        f"WHEN '-0,0' THEN '0,0' ELSE {text} END END"
    )


_BOOK_MONTHS = [p for p in MONTHS if p.year >= LAST.year - 1]
_BOOK_COLUMNS = ", ".join(
    f"CAST(sum(value) FILTER (WHERE period = DATE '{p}') AS double) AS \"{p:%Y-%m}\"" for p in _BOOK_MONTHS
)
_SECTION = {
    "m_on_m": ("m_on_m", "sum", "abs_change"),
    "y_on_y": ("m_on_m_last_year", "sum", "pct_change"),
    "ytd": ("ytd_on_ytd", "mean", "pp_change"),
}
_SIDES = ", ".join(
    f"{side} AS {tag}_{name}" for name, (period, aggregate, _) in _SECTION.items()
    for tag, side in zip("pc", _pair(period, aggregate))
)
_TOTALLED = """totalled AS (
  SELECT category, producer, false AS is_total, period, value FROM book
  UNION ALL SELECT 'Итого', NULL, true, period, sum(value) FROM book GROUP BY period)"""

_PRODUCT_LABELS = {
    "category": "Категория", "segment": "Сегмент", '"group"': "Товарная группа", "brand": "Бренд",
    "producer": "Производитель", "label": "Наименование",
}
_METRIC_LABELS = [
    "АКБ", "Оборачиваемость, шт/ТТ", "РТО, руб/ТТ", "ТО, шт", "ТО, кг", "Цена за шт", "Цена за кг", "ТО, руб.",
]
_PRINTED = ", ".join(
    f"max({m}) FILTER (WHERE period = DATE '{p}') AS \"{label} {p:%Y-%m}\""
    for m, label in zip(METRICS, _METRIC_LABELS) for p in MONTHS
)

ORACLES = {
    "printed_report": f"""WITH {_MONTHLY}, {_TOP}, {_NUMBERED},
        wide AS (SELECT {_ROW}, {_PRINTED} FROM cells GROUP BY ALL)
        SELECT w.network_subname, n.position, coalesce(n.number, '') AS "№ п/п",
               {', '.join(f"""coalesce(n.{c}, '') AS "{label}" """ for c, label in _PRODUCT_LABELS.items())},
               w.weight AS "Вес", w.* EXCLUDE ({_ROW})
        FROM wide w
        JOIN numbered n ON {' AND '.join(f'w.{k.strip()} IS NOT DISTINCT FROM n.{k.strip()}' for k in _ROW.split(','))}""",
    "date_texts": f"""
        SELECT strftime(day, '%d.%m.%Y') AS written, day, {_month_name('day')} AS month_title,
               CAST(CASE WHEN day(day) = 1 THEN day ELSE date_trunc('month', day) + INTERVAL 1 MONTH END AS date)
                   AS next_month,
               strftime(day, '%Y.%m.%d') || '-' ||
                   strftime(CAST(date_trunc('week', day + 6) AS date), '%Y.%m.%d') AS span
        FROM (SELECT DISTINCT CAST(l_shipdate AS date) AS day FROM lineitem)""",
    "derived_metrics": f"WITH {_MONTHLY} SELECT * FROM cells",
    "report_header": f"WITH {_MONTHLY} {_HEADER}",
    "report_header_weekly": f"WITH {_WEEKLY} {_HEADER}",
    "trailing_sales": f"WITH {_MONTHLY} SELECT * REPLACE ({_MONEY}, {_ALL}) FROM report_rows",
    "trailing_sales_weekly": f"WITH {_WEEKLY} SELECT * REPLACE ({_MONEY}, {_ALL}) FROM report_rows",
    "producer_pruning": f"""WITH {_MONTHLY}, {_TOP}
        SELECT network_subname, category, segment, "group", producer, {_MONEY},
               CAST(running_sales_3m AS double) AS running_sales_3m, {_GROUP}, is_top
        FROM tail""",
    "pruned_rows": f"""WITH {_MONTHLY}, {_tail("0.05", ["category", "segment", '"group"'])}
        SELECT * REPLACE ({_MONEY}, {_ALL}) FROM kept_rows""",
    "minor_sku_flags": f"""WITH {_MONTHLY}, {_marked('report_rows', 20000)}
        SELECT * REPLACE ({_MONEY}, {_ALL}, {_GROUP}) FROM marked""",
    "report_numbering": f"""WITH {_MONTHLY}, {_TOP}, {_NUMBERED}
        SELECT * EXCLUDE (sales_all) REPLACE ({_MONEY}) FROM numbered""",
    "report_pivot": f"WITH {_MONTHLY} SELECT {_ROW}, {_WIDE} FROM cells GROUP BY ALL",
    "sales_report": f"""WITH {_MONTHLY}, {_TOP}, {_marked('kept_rows', 100)}, {_NUMBERED},
        wide AS (SELECT {_ROW}, {_WIDE} FROM cells GROUP BY ALL)
        SELECT {', '.join(f"coalesce(w.{c}, '') AS {c}" for c in _TEXT[:6])}, coalesce(n.label, '') AS label,
               coalesce(n.number, '') AS number, n.position,
               CAST(n.sales_3m AS double) AS sales_3m, CAST(n.sales_all AS double) AS sales_all,
               CAST(m.group_sales_3m AS double) AS group_sales_3m, m.is_minor, m.is_own,
               w.* EXCLUDE ({', '.join(_TEXT[:6])})
        FROM wide w
        JOIN numbered n ON {' AND '.join(f'w.{k.strip()} IS NOT DISTINCT FROM n.{k.strip()}' for k in _ROW.split(','))}
        JOIN marked m ON {' AND '.join(f'w.{k.strip()} IS NOT DISTINCT FROM m.{k.strip()}' for k in _ROW.split(','))}""",
    "iso_week_labels": f"""WITH {FINE}
        SELECT week_start_date, CAST(sum(pieces) AS bigint) AS pieces, CAST(sum(sales_rub) AS double) AS sales_rub,
               strftime(week_start_date, '%G-%V') AS week_label
        FROM retail_sales GROUP BY week_start_date""",
    "totals_row": f"""WITH {_BOOK}, {_TOTALLED}
        SELECT * REPLACE (CAST(value AS double) AS value) FROM totalled""",
    "change_mom": _change("m_on_m"),
    "change_yoy": _change("m_on_m_last_year"),
    "change_ytd_sum": _change("ytd_on_ytd"),
    "change_ytd_mean": _change("ytd_on_ytd", "mean"),
    "change_formatted": f"""WITH changed AS ({_change('m_on_m')})
        SELECT category, producer,
               {', '.join(f"{_shown(f, 'previous', 'current')} AS {f}" for f in ('abs_change', 'pp_change', 'pct_change'))}
        FROM changed""",
    "databook_table": f"""WITH {_BOOK}, {_TOTALLED},
        sides AS (SELECT category, producer, is_total, {_BOOK_COLUMNS}, {_SIDES}
                  FROM totalled WHERE period BETWEEN DATE '{_BOOK_MONTHS[0]}' AND {_NOW}
                  GROUP BY category, producer, is_total)
        SELECT category, producer, is_total, {', '.join(f'"{p:%Y-%m}"' for p in _BOOK_MONTHS)},
               {', '.join(f"{_shown(form, f'p_{n}', f'c_{n}')} AS {n}" for n, (_, _, form) in _SECTION.items())}
        FROM sides""",
}

ORACLES |= {
    "databook_saved": ORACLES["databook_table"],
    "report_of_network": f"SELECT * FROM ({ORACLES['sales_report']}) WHERE network_subname = 'NATION_12'",
}
