"""Measure queries at the report grains (§2.11) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from starwright import oracle as O
from starwright.plans import context as C
from starwright.plans import measures as M
from starwright.plans.warehouse import Warehouse
from starwright.registry import register


def _lines(wh: Warehouse):
    return M.sales_lines(wh.fact_sales)


# ------------------------------------------------------------ oracle helpers
def _ratio(a: str, b: str) -> str:
    return (f"CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN NULL "
            f"ELSE CAST(({a}) AS DOUBLE) / CAST(({b}) AS DOUBLE) END")


def _bdiff(a: str, b: str) -> str:
    return f"CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE COALESCE({a}, 0) - COALESCE({b}, 0) END"


BASE = """CAST(sum(net_amount) AS DECIMAL(38,4)) AS net_sales,
       CAST(count(DISTINCT sales_order_id) AS BIGINT) AS orders,
       CAST(sum(order_quantity) AS BIGINT) AS units,
       CAST(sum(unit_price * order_quantity) AS DECIMAL(38,4)) AS gross_value,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS active_customers,
       CAST(count(DISTINCT product_id) AS BIGINT) AS products_sold,
       CAST(count(*) AS BIGINT) AS line_count"""


def _derived(src: str) -> str:
    dv = f"CAST({_bdiff('gross_value', 'net_sales')} AS DECIMAL(38,4))"
    return f"""SELECT *,
       {_ratio('net_sales', 'orders')} AS avg_ticket,
       {_ratio('net_sales', 'units')} AS avg_unit_value,
       {_ratio('units', 'orders')} AS units_per_order,
       {dv} AS discount_value,
       {_ratio(dv, 'gross_value')} AS discount_pct,
       {_ratio('net_sales', 'active_customers')} AS revenue_per_customer,
       {_ratio('orders', 'active_customers')} AS orders_per_customer,
       {_ratio('units', 'products_sold')} AS units_per_product,
       {_ratio('net_sales', 'products_sold')} AS sales_per_product,
       {_ratio('net_sales', 'units')} AS avg_realized_price,
       {_ratio('units', 'line_count')} AS units_per_line,
       {_ratio('net_sales', 'active_customers')} AS sales_per_customer
FROM ({src}) d"""


O.cte("m_tot", ["fact_sales"], f"SELECT {BASE} FROM fact_sales")


def _recurring(keys: list[str], src: str) -> str:
    k = ", ".join(keys)
    kk = (k + ", ") if keys else ""
    group = f"GROUP BY {k}" if keys else ""
    return f"""
SELECT {kk}{"CAST(count(*) AS BIGINT)" if keys else "NULLIF(CAST(count(*) AS BIGINT), 0)"}
         AS recurring_customers,
       CAST(sum(c_orders) AS BIGINT) AS recurring_orders,
       CAST(sum(c_net) AS DECIMAL(38,4)) AS sales_recurring
FROM (SELECT {kk}customer_id, count(DISTINCT sales_order_id) AS c_orders,
             sum(net_amount) AS c_net
      FROM {src} GROUP BY {kk}customer_id) pc
WHERE c_orders > 1 {group}"""


def _recurring_measures(src: str) -> str:
    one = _bdiff("active_customers", "recurring_customers")
    s1 = f"CAST({_bdiff('net_sales', 'sales_recurring')} AS DECIMAL(38,4))"
    tr = _ratio("sales_recurring", "recurring_orders")
    t1 = _ratio(s1, one)
    return f"""SELECT *,
       {_ratio('recurring_customers', 'active_customers')} AS recurring_rate,
       CAST({one} AS BIGINT) AS one_time_customers,
       {_ratio(one, 'active_customers')} AS one_time_rate,
       {_ratio('recurring_orders', 'recurring_customers')} AS orders_per_recurring,
       {_ratio('sales_recurring', 'net_sales')} AS share_recurring,
       {tr} AS ticket_recurring,
       {s1} AS sales_one_time,
       {t1} AS ticket_one_time,
       {_ratio(tr, t1)} AS ticket_index_recurring
FROM ({src}) r"""


def _dense(value: str, where: str | None = None) -> str:
    score = f"COALESCE({value}, 0)"
    if where is None:
        return f"CAST(dense_rank() OVER (ORDER BY {score} DESC) AS INTEGER)"
    return (f"CASE WHEN {where} THEN CAST(dense_rank() OVER (PARTITION BY ({where}) "
            f"ORDER BY {score} DESC) AS INTEGER) END")


def _top10(key_src: str) -> str:
    """Members whose net sales are >= the 10th largest (TOPN with ties)."""
    return (f"(SELECT min(net_sales) AS thr FROM (SELECT net_sales FROM {key_src} "
            f"WHERE net_sales IS NOT NULL ORDER BY net_sales DESC LIMIT 10) x)")


# ------------------------------------------------------------ product grain
O.cte("mp_lines", ["fact_sales", "dim_product"], """
SELECT f.*, p.product_name FROM fact_sales f LEFT JOIN dim_product p USING (product_id)""")
O.cte("mp_g", ["mp_lines"], _derived(f"SELECT product_name, {BASE} FROM mp_lines GROUP BY 1"))
_PRODUCT_SQL = O.sql(f"""
SELECT g.*,
       {_ratio('g.net_sales', 't.net_sales')} AS product_share_sales,
       {_ratio('g.units', 't.units')} AS product_share_units,
       {_dense('g.net_sales')} AS product_rank_sales,
       {_dense('g.units')} AS product_rank_units,
       CASE WHEN {_dense('g.net_sales')} <= 10 THEN 1 ELSE 0 END AS product_is_top10,
       g.discount_pct AS discount_pct_product,
       CASE WHEN g.net_sales >= th.thr THEN g.net_sales END AS sales_top10_products,
       {_ratio('CASE WHEN g.net_sales >= th.thr THEN g.net_sales END', 'g.net_sales')}
         AS share_top10_products
FROM mp_g g CROSS JOIN m_tot t CROSS JOIN {_top10('mp_g')} th""", "mp_g", "m_tot")


@register("measures_by_product", _PRODUCT_SQL)
def measures_by_product(spark, sf_dir):
    """M-25…M-37 per product name: shares, dense ranks, top-10 flag and sales."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.product_grain(_lines(wh), wh.dim_product)


# ----------------------------------------------------------- customer grain
O.cte("mc_lines", ["fact_sales", "dim_customer"], """
SELECT f.*, c.person_name FROM fact_sales f LEFT JOIN dim_customer c USING (customer_id)""")
O.cte("mc_g", ["mc_lines"], _derived(f"SELECT person_name, {BASE} FROM mc_lines GROUP BY 1"))
_CUSTOMER_SQL = O.sql(f"""
SELECT g.*,
       {_ratio('g.net_sales', 't.net_sales')} AS customer_share_sales,
       {_dense('g.net_sales')} AS customer_rank_sales,
       CASE WHEN {_dense('g.net_sales')} <= 10 THEN 1 ELSE 0 END AS customer_is_top10,
       CASE WHEN g.net_sales >= th.thr THEN g.net_sales END AS sales_top10_customers,
       {_ratio('CASE WHEN g.net_sales >= th.thr THEN g.net_sales END', 'g.net_sales')}
         AS share_top10_customers
FROM mc_g g CROSS JOIN m_tot t CROSS JOIN {_top10('mc_g')} th""", "mc_g", "m_tot")


@register("measures_by_customer", _CUSTOMER_SQL)
def measures_by_customer(spark, sf_dir):
    """M-38…M-42 per customer name: share, dense rank, top-10 flag and sales."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.customer_grain(_lines(wh), wh.dim_customer)


# ---------------------------------------------------------- territory grain
O.cte("mt_lines", ["fact_sales", "dim_sales_territory"], """
SELECT f.*, t.territory_name
FROM fact_sales f LEFT JOIN dim_sales_territory t USING (territory_id)""")
O.cte("mt_g", ["mt_lines"], _recurring_measures(
    f"SELECT b.*, r.recurring_customers, r.recurring_orders, r.sales_recurring "
    f"FROM ({_derived(f'SELECT territory_name, {BASE} FROM mt_lines GROUP BY 1')}) b "
    f"LEFT JOIN ({_recurring(['territory_name'], 'mt_lines')}) r "
    f"ON b.territory_name IS NOT DISTINCT FROM r.territory_name"))
_TERRITORY_SQL = O.sql(f"""
SELECT g.*,
       {_ratio('g.net_sales', 't.net_sales')} AS territory_share_sales,
       {_ratio('g.orders', 't.orders')} AS territory_share_orders,
       {_ratio('g.avg_ticket', _ratio('t.net_sales', 't.orders'))} AS territory_ticket_index,
       {_ratio('g.sales_per_customer', _ratio('t.net_sales', 't.active_customers'))}
         AS territory_customer_index,
       g.active_customers AS active_customers_territory,
       {_dense('g.net_sales')} AS territory_rank_sales
FROM mt_g g CROSS JOIN m_tot t""", "mt_g", "m_tot")


@register("measures_by_territory", _TERRITORY_SQL)
def measures_by_territory(spark, sf_dir):
    """M-43…M-60 per territory: recurring-customer block, shares, indices, rank."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.territory_grain(_lines(wh), wh.dim_sales_territory)


# -------------------------------------------------------- sales person grain
O.cte("ms_lines", ["fact_sales", "dim_sales_person"], """
SELECT f.*, s.full_name FROM fact_sales f LEFT JOIN dim_sales_person s USING (sales_person_id)""")
O.cte("ms_g", ["ms_lines"], _derived(f"SELECT full_name, {BASE} FROM ms_lines GROUP BY 1"))
_SALESPERSON_SQL = O.sql(f"""
SELECT g.*,
       {_ratio('g.net_sales', 't.net_sales')} AS salesperson_share_sales,
       {_ratio('g.orders', 't.orders')} AS salesperson_share_orders,
       {_ratio('g.avg_ticket', _ratio('t.net_sales', 't.orders'))} AS salesperson_ticket_index,
       {_ratio('g.sales_per_customer', _ratio('t.net_sales', 't.active_customers'))}
         AS salesperson_customer_index,
       {_dense('g.net_sales', 'g.full_name IS NOT NULL')} AS salesperson_rank_sales
FROM ms_g g CROSS JOIN m_tot t""", "ms_g", "m_tot")


@register("measures_by_sales_person", _SALESPERSON_SQL)
def measures_by_sales_person(spark, sf_dir):
    """M-61…M-65 per sales person (blank member kept, unranked)."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.sales_person_grain(_lines(wh), wh.dim_sales_person)


# ---------------------------------------------------------------- overall
_OVERALL_SQL = O.sql(f"""
SELECT o.*,
       p.sales_top10_products, c.sales_top10_customers,
       {_ratio('p.sales_top10_products', 'o.net_sales')} AS share_top10_products,
       {_ratio('c.sales_top10_customers', 'o.net_sales')} AS share_top10_customers,
       1 AS product_is_top10, 1 AS customer_is_top10
FROM ({_recurring_measures(
    f"SELECT d.*, r.* FROM ({_derived('SELECT * FROM m_tot')}) d "
    f"CROSS JOIN ({_recurring([], 'fact_sales')}) r")}) o
CROSS JOIN (SELECT CAST(sum(net_sales) AS DECIMAL(38,4)) AS sales_top10_products
            FROM mp_g, {_top10('mp_g')} th WHERE net_sales >= th.thr) p
CROSS JOIN (SELECT CAST(sum(net_sales) AS DECIMAL(38,4)) AS sales_top10_customers
            FROM mc_g, {_top10('mc_g')} th WHERE net_sales >= th.thr) c""",
                     "m_tot", "mp_g", "mc_g")


@register("measures_overall", _OVERALL_SQL)
def measures_overall(spark, sf_dir):
    """Card values with no grouping (totals, recurring block, top-10 blocks)."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.overall(_lines(wh), wh.dim_product, wh.dim_customer)


# ------------------------------------------------------- time intelligence
O.cte("mm_base", ["fact_sales"], _derived(f"""
SELECT CAST((order_date_id // 10000) * 12 + (order_date_id // 100) % 100 - 1 AS INTEGER)
         AS month_index, {BASE}
FROM fact_sales GROUP BY 1"""))
O.cte("mm_spine", ["dim_date", "mm_base"], """
SELECT s.year_number, s.month_number, s.month_name, b.* EXCLUDE (month_index), s.month_index
FROM (SELECT year_number, month_number, month_name,
             CAST(year_number * 12 + month_number - 1 AS INTEGER) AS month_index
      FROM dim_date GROUP BY 1, 2, 3) s
LEFT JOIN mm_base b USING (month_index)""")
O.cte("mm_w", ["mm_spine"], """
SELECT *,
       lag(net_sales, 12) OVER (ORDER BY month_index) AS net_sales_ly,
       lag(net_sales, 1) OVER (ORDER BY month_index) AS net_sales_pm,
       sum(net_sales) OVER (PARTITION BY year_number ORDER BY month_index
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS net_sales_ytd,
       sum(net_sales) OVER (PARTITION BY year_number) AS y_total,
       sum(net_sales) OVER (ORDER BY month_index ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
         AS m3_sum,
       count(net_sales) OVER (ORDER BY month_index ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
         AS m3_n
FROM mm_spine""")
O.cte("mm_w2", ["mm_w"], """
SELECT *, lag(net_sales_ytd, 12) OVER (ORDER BY month_index) AS net_sales_ytd_ly FROM mm_w""")
_both = "({a} IS NOT NULL AND {b} IS NOT NULL)"
_MONTH_SQL = O.sql(f"""
SELECT * EXCLUDE (month_index, y_total, m3_sum, m3_n, net_sales_ly, net_sales_pm, net_sales_ytd,
                  net_sales_ytd_ly),
       CAST(net_sales_ly AS DECIMAL(38,4)) AS net_sales_ly,
       CAST(net_sales_pm AS DECIMAL(38,4)) AS net_sales_pm,
       CAST(net_sales_ytd AS DECIMAL(38,4)) AS net_sales_ytd,
       CAST(net_sales_ytd_ly AS DECIMAL(38,4)) AS net_sales_ytd_ly,
       CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
            THEN {_ratio('net_sales - net_sales_ly', 'net_sales_ly')} END AS yoy_growth,
       CAST(CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
            THEN net_sales - net_sales_ly END AS DECIMAL(38,4)) AS yoy_change,
       CASE WHEN {_both.format(a='net_sales_ytd', b='net_sales_ytd_ly')}
            THEN {_ratio('net_sales_ytd - net_sales_ytd_ly', 'net_sales_ytd_ly')} END
         AS ytd_growth,
       CAST(CASE WHEN {_both.format(a='net_sales_ytd', b='net_sales_ytd_ly')}
            THEN net_sales_ytd - net_sales_ytd_ly END AS DECIMAL(38,4)) AS ytd_change,
       CASE WHEN {_both.format(a='net_sales', b='net_sales_pm')}
            THEN {_ratio('net_sales - net_sales_pm', 'net_sales_pm')} END AS mom_growth,
       CAST(CASE WHEN {_both.format(a='net_sales', b='net_sales_pm')}
            THEN net_sales - net_sales_pm END AS DECIMAL(38,4)) AS mom_change,
       {_ratio('net_sales', 'y_total')} AS share_of_year,
       {_ratio('m3_sum', 'CASE WHEN m3_n > 0 THEN m3_n END')} AS moving_avg_3m
FROM mm_w2
WHERE COALESCE(CAST(net_sales AS VARCHAR), CAST(net_sales_ly AS VARCHAR),
               CAST(net_sales_ytd AS VARCHAR), CAST(net_sales_ytd_ly AS VARCHAR),
               CAST(net_sales_pm AS VARCHAR),
               CAST({_ratio('m3_sum', 'CASE WHEN m3_n > 0 THEN m3_n END')} AS VARCHAR))
      IS NOT NULL""", "mm_w2")


@register("measures_by_month", _MONTH_SQL)
def measures_by_month(spark, sf_dir):
    """M-1…M-24 per calendar month: base measures, prior year / month, YTD,
    YoY / MoM growth, share of the year and the 3-month moving average."""
    wh = Warehouse.from_driver(spark, sf_dir)
    # O-5: month names are displayed in month-number order (bounded: calendar months)
    return M.month_grain(_lines(wh), wh.dim_date).orderBy("year_number", "month_number")


O.cte("my_base", ["fact_sales"], _derived(f"""
SELECT CAST(order_date_id // 10000 AS INTEGER) AS year_number, {BASE}
FROM fact_sales GROUP BY 1"""))
_YEAR_SQL = O.sql(f"""
SELECT *, net_sales AS net_sales_ytd, net_sales_ly AS net_sales_ytd_ly,
       yoy_growth AS ytd_growth, yoy_change AS ytd_change
FROM (SELECT *,
             CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
                  THEN {_ratio('net_sales - net_sales_ly', 'net_sales_ly')} END AS yoy_growth,
             CAST(CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
                  THEN net_sales - net_sales_ly END AS DECIMAL(38,4)) AS yoy_change
      FROM (SELECT y.year_number, b.* EXCLUDE (year_number),
                   CAST(lag(b.net_sales, 1) OVER (ORDER BY y.year_number) AS DECIMAL(38,4))
                     AS net_sales_ly
            FROM (SELECT DISTINCT year_number FROM dim_date) y
            LEFT JOIN my_base b USING (year_number)) z) q
WHERE net_sales IS NOT NULL OR net_sales_ly IS NOT NULL""", "my_base", "dim_date")


@register("measures_by_year", _YEAR_SQL)
def measures_by_year(spark, sf_dir):
    """Year grain: base measures, prior year, YoY and YTD (= year total here)."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.year_grain(_lines(wh), wh.dim_date)


O.cte("md_base", ["fact_sales"], """
SELECT order_date_id AS date_id, CAST(sum(net_amount) AS DECIMAL(38,4)) AS net_sales,
       CAST(count(DISTINCT sales_order_id) AS BIGINT) AS orders
FROM fact_sales GROUP BY 1""")
_DAY_SQL = O.sql(f"""
SELECT date_id, full_date, net_sales, orders, net_sales_ly,
       CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
            THEN {_ratio('net_sales - net_sales_ly', 'net_sales_ly')} END AS yoy_growth,
       CAST(CASE WHEN {_both.format(a='net_sales', b='net_sales_ly')}
            THEN net_sales - net_sales_ly END AS DECIMAL(38,4)) AS yoy_change
FROM (SELECT c.date_id, c.full_date, b.net_sales, b.orders, l.net_sales AS net_sales_ly
      FROM dim_date c
      LEFT JOIN md_base b ON b.date_id = c.date_id
      LEFT JOIN md_base l ON l.date_id = CAST(strftime(CAST(c.full_date - INTERVAL 1 YEAR AS DATE),
                                                       '%Y%m%d') AS INTEGER)) x
WHERE net_sales IS NOT NULL OR net_sales_ly IS NOT NULL""", "md_base", "dim_date")


@register("measures_by_day", _DAY_SQL)
def measures_by_day(spark, sf_dir):
    """M-13…M-15 at day grain: net sales against the same day a year earlier."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return M.day_grain(_lines(wh), wh.dim_date)


# ---------------------------------------------------------- filter context
O.cte("mx_lines", ["fact_sales", "dim_sales_territory"], """
SELECT f.*, t.territory_name, t.territory_group,
       CAST(order_date_id // 10000 AS INTEGER) AS year_number,
       CAST((order_date_id // 100) % 100 AS INTEGER) AS month_number
FROM fact_sales f LEFT JOIN dim_sales_territory t USING (territory_id)""")


def _context_sql(keys: list[str], removed: list[str], where: str = "TRUE") -> str:
    """The measures at ``keys`` from the lines themselves, shares against the same
    lines without the filters of ``removed``."""
    k, rest = ", ".join(keys), [x for x in keys if x not in removed]
    on = " AND ".join(f"g.{x} IS NOT DISTINCT FROM a.{x}" for x in rest) or "TRUE"
    group = f"GROUP BY {', '.join(rest)}" if rest else ""
    rank = (f""", CAST(dense_rank() OVER (PARTITION BY {', '.join('g.' + x for x in rest)}
              ORDER BY COALESCE(g.net_sales, 0) DESC) AS INTEGER) AS rank_net_sales"""
            if rest else "")
    return f"""
SELECT g.*, {_ratio('g.net_sales', 'a.net_sales')} AS share_net_sales,
       {_ratio('g.orders', 'a.orders')} AS share_orders,
       {_ratio('g.avg_ticket', _ratio('a.net_sales', 'a.orders'))} AS ticket_index,
       {_ratio('g.sales_per_customer', _ratio('a.net_sales', 'a.active_customers'))}
         AS customer_index{rank}
FROM ({_derived(f"SELECT {k}, {BASE} FROM mx_lines WHERE {where} GROUP BY {k}")}) g
JOIN (SELECT {', '.join([*rest, BASE])} FROM mx_lines {group}) a ON {on}"""


_TERRITORY = ["territory_group", "territory_name"]


@register("measures_by_territory_month",
          O.sql(_context_sql(C.CONTEXT_KEYS, _TERRITORY), "mx_lines"))
def measures_by_territory_month(spark, sf_dir):
    """W-7 with remaining keys: a territory's share, indices and rank of each month."""
    return C.measures(Warehouse.from_driver(spark, sf_dir).sales_cells, C.CONTEXT_KEYS,
                      removed=_TERRITORY)


@register("measures_by_group_year",
          O.sql(_context_sql(["territory_group", "year_number"], ["year_number"]), "mx_lines"))
def measures_by_group_year(spark, sf_dir):
    """A coarser grain of the same cells: a year's share of its territory group."""
    return C.measures(Warehouse.from_driver(spark, sf_dir).sales_cells,
                      ["territory_group", "year_number"], removed=["year_number"])


# the slicer's choice on the report page
_CHOSEN = ("NATION_3", "NATION_7", "NATION_12")


@register("measures_sliced_by_territory", O.sql(
    _context_sql(["territory_name"], ["territory_name"],
                 f"territory_name IN {_CHOSEN}"), "mx_lines"))
def measures_sliced_by_territory(spark, sf_dir):
    """P-21: the chosen territories, shares against all of them."""
    return C.measures(Warehouse.from_driver(spark, sf_dir).sales_cells, ["territory_name"],
                      F.col("territory_name").isin(*_CHOSEN), ["territory_name"])


@register("cards_sliced_by_territory", O.sql(
    _derived(f"SELECT {BASE} FROM mx_lines WHERE territory_name IN {_CHOSEN}"), "mx_lines"))
def cards_sliced_by_territory(spark, sf_dir):
    """P-21: the cards of the page below the slicer; a customer or product of several
    chosen territories counts once."""
    return C.measures(Warehouse.from_driver(spark, sf_dir).sales_cells, [],
                      F.col("territory_name").isin(*_CHOSEN))
