"""DuckDB oracle SQL for the registered queries.

Independent SQL formulations of the same models over the driver's tables
(pre-registered as views ``orders``, ``lineitem``, …), used by the correctness
gate and the tests.  ``sql(select, *ctes)`` prepends the named CTEs and their
dependencies in order.  Casts are explicit wherever the two engines widen
types differently (sums, divisions, extracts).
"""

from __future__ import annotations

AS_OF = "DATE '2025-06-30'"
FUTURE_YEARS = 2
LOADED_AT = "TIMESTAMP '2001-08-02 06:00:00'"


def _uuid(key: str) -> str:
    return f"'00000000-0000-4000-8000-' || lpad(CAST({key} AS VARCHAR), CAST(greatest(length(CAST({key} AS VARCHAR)), 12) AS INTEGER), '0')"


def _days_after(ts: str, days: str) -> str:
    return f"(TIMESTAMP '{ts}' + to_days(CAST({days} AS INTEGER)))"


def _date_key(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def div4(num: str, den: str) -> str:
    """Exact ``num/den`` rounded half away from zero to 4 places, as decimal(19,4):
    ``num`` is a scale-4 decimal, ``den`` a positive integer."""
    n = f"CAST(({num}) * 10000 AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"(sign({n}) * ((abs({n}) * 2 + {d}) // ({d} * 2)))"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(19,4))"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def sql(select: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select
    head = "WITH RECURSIVE " if any(n in RECURSIVE for n in order) else "WITH "
    return head + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + select


RECURSIVE: set[str] = set()


# --------------------------------------------------------------- staging
cte("stg_salesorderheader", [], f"""
SELECT o.o_orderkey AS sales_order_id,
       o.o_orderdate AS order_date,
       o.o_orderdate + INTERVAL 12 DAY AS due_date,
       CAST(NULL AS TIMESTAMP) AS ship_date,
       CAST(CASE o.o_orderstatus WHEN 'F' THEN 5 WHEN 'P' THEN 2 ELSE 1 END AS SMALLINT)
         AS order_status,
       o.o_orderpriority = '5-LOW' AS is_online_order,
       o.o_custkey AS customer_id,
       CAST(NULL AS BIGINT) AS sales_person_id,
       c.c_nationkey AS territory_id,
       CAST(o.o_totalprice AS DECIMAL(19,4)) AS subtotal,
       o.o_orderdate + INTERVAL 12 DAY AS modified_at,
       {LOADED_AT} AS _loaded_at,
       CAST(8 AS SMALLINT) AS revision_number,
       CASE WHEN o.o_orderpriority <> '5-LOW' THEN 'PO' || CAST(o.o_orderkey AS VARCHAR) END
         AS purchase_order_number,
       '10-' || lpad(CAST(o.o_custkey AS VARCHAR), CAST(greatest(length(CAST(o.o_custkey AS VARCHAR)), 10) AS INTEGER), '0') AS account_number,
       o.o_custkey AS bill_to_address_id,
       o.o_custkey AS ship_to_address_id,
       CAST(CASE WHEN o.o_orderpriority = '5-LOW' THEN 1 ELSE 5 END AS INTEGER) AS ship_method_id,
       CAST(NULL AS INTEGER) AS credit_card_id,
       CAST(NULL AS VARCHAR) AS credit_card_approval_code,
       CAST(NULL AS INTEGER) AS currency_rate_id,
       CAST(0 AS DECIMAL(19,4)) AS tax_amount,
       CAST(0 AS DECIMAL(19,4)) AS freight,
       CAST(o.o_totalprice AS DECIMAL(19,4)) AS total_due,
       CAST(NULL AS VARCHAR) AS comment,
       {_uuid('o.o_orderkey')} AS row_guid,
       'sales.salesorderheader' AS _source_table
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

cte("stg_salesorderdetail", [], f"""
SELECT l_orderkey AS sales_order_id,
       l_orderkey * 1000000 + row_number() OVER (
         PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
         AS sales_order_detail_id,
       CAST(NULL AS VARCHAR) AS carrier_tracking_number,
       CAST(l_quantity AS SMALLINT) AS order_quantity,
       l_partkey AS product_id,
       CAST(round(l_discount * 100) AS INTEGER) + 1 AS special_offer_id,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS unit_price,
       CAST(l_discount AS DECIMAL(19,4)) AS unit_price_discount,
       l_shipdate AS modified_at,
       {LOADED_AT} AS _loaded_at,
       CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS line_ship_date,
       l_suppkey * 2 + 1 AS line_sales_person_id,
       'sales.salesorderdetail' AS _source_table
FROM lineitem""")

cte("stg_salesorderdetail_full", ["stg_salesorderdetail"], f"""
SELECT *, {_uuid('sales_order_detail_id')} AS row_guid FROM stg_salesorderdetail""")

cte("stg_customer", [], f"""
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 10 <= 6 THEN c_custkey * 2 END AS person_id,
       CASE WHEN c_custkey % 10 BETWEEN 5 AND 8 THEN c_custkey END AS store_id,
       c_nationkey AS territory_id,
       {_uuid('c_custkey')} AS row_guid,
       {_days_after('2001-01-01 00:00:00', 'c_custkey % 40')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'sales.customer' AS _source_table
FROM customer""")

_PERSON_COLS = """
       FALSE AS name_style,
       CAST(NULL AS VARCHAR) AS title,
       CAST(NULL AS VARCHAR) AS suffix,
       CAST(({key}) % 3 AS INTEGER) AS email_promotion,
       CAST(NULL AS VARCHAR) AS additional_contact_info,
       CAST(NULL AS VARCHAR) AS demographics,
       '00000000-0000-4000-8000-' || lpad(CAST({key} AS VARCHAR), CAST(greatest(length(CAST({key} AS VARCHAR)), 12) AS INTEGER), '0') AS row_guid,
       'person.person' AS _source_table,
       split_part({name}, '#', 1) AS first_name,
       CASE WHEN ({key}) % 3 = 0 THEN 'M' END AS middle_name,
       split_part({name}, '#', 2) AS last_name,
       {mod} AS modified_at"""

cte("stg_person", [], f"""
SELECT c_custkey * 2 AS business_entity_id, 'IN' AS person_type,
{_PERSON_COLS.format(name='c_name', key='c_custkey * 2',
                     mod=_days_after('2001-01-15 00:00:00', '(c_custkey * 2) % 40'))},
       {LOADED_AT} AS _loaded_at
FROM customer WHERE c_custkey % 10 <= 6
UNION ALL
SELECT s_suppkey * 2 + 1, 'SP',
{_PERSON_COLS.format(name='s_name', key='s_suppkey * 2 + 1',
                     mod=_days_after('2001-01-15 00:00:00', '(s_suppkey * 2 + 1) % 40'))},
       {LOADED_AT}
FROM supplier""")

cte("stg_store", [], f"""
SELECT c_custkey AS business_entity_id,
       'Store ' || CAST(c_custkey AS VARCHAR) AS store_name,
       CAST(NULL AS BIGINT) AS sales_person_id,
       CAST(NULL AS VARCHAR) AS demographics,
       {_uuid('c_custkey')} AS row_guid,
       {_days_after('2001-02-01 00:00:00', 'c_custkey % 20')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'sales.store' AS _source_table
FROM customer WHERE c_custkey % 10 BETWEEN 5 AND 8""")

cte("stg_product", [], f"""
SELECT p_partkey AS product_id,
       p_name AS product_name,
       p_brand || '-' || CAST(p_partkey AS VARCHAR) AS product_number,
       p_size > 25 AS is_manufactured,
       TRUE AS is_finished_good,
       CAST(NULL AS VARCHAR) AS color,
       CAST(p_size AS VARCHAR) AS size,
       'CM' AS size_unit_measure_code,
       CAST(NULL AS DECIMAL(8,2)) AS weight,
       CAST(NULL AS VARCHAR) AS weight_unit_measure_code,
       substring(p_type, 1, 1) AS product_line,
       CAST(NULL AS VARCHAR) AS product_class,
       CAST(NULL AS VARCHAR) AS product_style,
       CAST(p_size * 10 AS SMALLINT) AS safety_stock_level,
       CAST(p_size * 5 AS SMALLINT) AS reorder_point,
       CAST(p_size % 5 AS INTEGER) AS days_to_manufacture,
       CAST(p_retailprice AS DECIMAL(19,4)) AS standard_cost,
       CAST(p_retailprice AS DECIMAL(19,4)) AS list_price,
       CAST(p_size % 37 + 1 AS INTEGER) AS product_subcategory_id,
       CAST(NULL AS INTEGER) AS product_model_id,
       TIMESTAMP '1995-01-01 00:00:00' AS sell_start_date,
       CAST(NULL AS TIMESTAMP) AS sell_end_date,
       CAST(NULL AS TIMESTAMP) AS discontinued_date,
       {_uuid('p_partkey')} AS row_guid,
       {_days_after('2001-03-01 00:00:00', 'p_partkey % 30')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'production.product' AS _source_table
FROM part""")

cte("stg_salesterritory", [], f"""
SELECT n_nationkey AS territory_id,
       n_name AS territory_name,
       'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_region_code,
       r_name AS territory_group,
       CAST(0 AS DECIMAL(19,4)) AS sales_ytd,
       CAST(0 AS DECIMAL(19,4)) AS sales_last_year,
       CAST(0 AS DECIMAL(19,4)) AS cost_ytd,
       CAST(0 AS DECIMAL(19,4)) AS cost_last_year,
       {_uuid('n_nationkey')} AS row_guid,
       {_days_after('2001-01-01 00:00:00', 'n_nationkey')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'sales.salesterritory' AS _source_table
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

cte("stg_specialoffer", [], f"""
SELECT special_offer_id,
       'Discount ' || CAST(special_offer_id - 1 AS VARCHAR) || '%' AS special_offer_description,
       CAST((special_offer_id - 1) / 100 AS DECIMAL(19,4)) AS discount_percentage,
       CASE WHEN special_offer_id = 1 THEN 'No Discount' ELSE 'Volume Discount' END AS offer_type,
       CASE WHEN special_offer_id = 1 THEN 'No Discount' ELSE 'Reseller' END AS offer_category,
       TIMESTAMP '1995-01-01 00:00:00' AS start_date,
       TIMESTAMP '2001-12-31 00:00:00' AS end_date,
       0 AS minimum_quantity,
       CAST(NULL AS INTEGER) AS maximum_quantity,
       {_uuid('special_offer_id')} AS row_guid,
       {_days_after('2001-01-01 00:00:00', 'special_offer_id')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'sales.specialoffer' AS _source_table
FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS INTEGER) + 1 AS special_offer_id
      FROM lineitem)""")

cte("stg_salesperson", [], f"""
SELECT s_suppkey * 2 + 1 AS business_entity_id,
       s_nationkey AS territory_id,
       CASE WHEN s_suppkey % 4 <> 0 THEN CAST(abs(s_acctbal) * 100 AS DECIMAL(19,4)) END
         AS sales_quota,
       CAST(abs(s_acctbal) AS DECIMAL(19,4)) AS bonus,
       CAST((s_suppkey % 3) / 100 AS DECIMAL(10,4)) AS commission_pct,
       CAST(0 AS DECIMAL(19,4)) AS sales_ytd,
       CAST(0 AS DECIMAL(19,4)) AS sales_last_year,
       {_uuid('s_suppkey * 2 + 1')} AS row_guid,
       {_days_after('2001-01-01 00:00:00', 's_suppkey % 30')} AS modified_at,
       {LOADED_AT} AS _loaded_at,
       'sales.salesperson' AS _source_table
FROM supplier""")

cte("stg_employee", [], f"""
SELECT s_suppkey * 2 + 1 AS business_entity_id,
       CAST(s_suppkey AS VARCHAR) AS national_id_number,
       'sp' || CAST(s_suppkey AS VARCHAR) AS login_id,
       'Sales Representative' AS job_title,
       CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'S' END AS marital_status,
       CASE WHEN s_suppkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender,
       CAST(DATE '1970-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS DATE) AS birth_date,
       CAST(DATE '1994-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS DATE) AS hire_date,
       s_suppkey % 2 = 0 AS is_salaried,
       CAST(s_suppkey % 100 AS SMALLINT) AS vacation_hours,
       CAST(s_suppkey % 70 AS SMALLINT) AS sick_leave_hours,
       TRUE AS is_current,
       {_uuid('s_suppkey * 2 + 1')} AS row_guid,
       {_days_after('2001-02-01 00:00:00', 's_suppkey % 20')} AS modified_at,
       '/1/' || CAST(s_suppkey AS VARCHAR) || '/' AS organization_node,
       {LOADED_AT} AS _loaded_at,
       'humanresources.employee' AS _source_table
FROM supplier""")

# ----------------------------------------------------------- intermediate
cte("int_sales_order_items", ["stg_salesorderheader", "stg_salesorderdetail"], """
SELECT i.sales_order_detail_id, i.sales_order_id, i.product_id, o.customer_id,
       COALESCE(o.sales_person_id,
                CASE WHEN NOT o.is_online_order THEN i.line_sales_person_id END)
         AS sales_person_id,
       o.territory_id, o.order_date, o.due_date,
       COALESCE(o.ship_date, i.line_ship_date) AS ship_date,
       o.order_status, o.is_online_order,
       i.order_quantity, i.unit_price, i.unit_price_discount,
       CAST(i.order_quantity * i.unit_price AS DECIMAL(19,4)) AS gross_amount,
       CAST(i.order_quantity * i.unit_price * CAST(i.unit_price_discount AS DECIMAL(5,4))
            AS DECIMAL(19,4)) AS discount_amount,
       CAST(i.order_quantity * i.unit_price * (1 - CAST(i.unit_price_discount AS DECIMAL(5,4)))
            AS DECIMAL(19,4)) AS net_amount,
       i.special_offer_id, i.carrier_tracking_number,
       greatest(o.modified_at, i.modified_at) AS modified_at
FROM stg_salesorderdetail i JOIN stg_salesorderheader o ON i.sales_order_id = o.sales_order_id""")

# -------------------------------------------------------------- analytics
cte("fact_sales", ["int_sales_order_items"], f"""
SELECT sales_order_detail_id, sales_order_id, product_id, customer_id, sales_person_id,
       territory_id, special_offer_id,
       {_date_key('order_date')} AS order_date_id,
       {_date_key('due_date')} AS due_date_id,
       CASE WHEN ship_date IS NOT NULL THEN {_date_key('ship_date')} END AS ship_date_id,
       order_status, is_online_order, order_quantity, unit_price, unit_price_discount,
       gross_amount, discount_amount, net_amount, carrier_tracking_number, modified_at
FROM int_sales_order_items""")

cte("fs_sales", ["fact_sales"], """
SELECT make_date(CAST(order_date_id // 10000 AS INTEGER),
                 CAST((order_date_id // 100) % 100 AS INTEGER),
                 CAST(order_date_id % 100 AS INTEGER)) AS order_date,
       sales_order_id, customer_id, order_quantity, gross_amount, discount_amount, net_amount
FROM fact_sales""")

cte("fs_bounds", ["fs_sales"], """
SELECT min(order_date) AS first_available_date, max(order_date) AS last_available_date
FROM fs_sales""")

cte("fs_spine", ["fs_bounds"], """
SELECT CAST(unnest(generate_series(CAST(date_trunc('month', first_available_date) AS TIMESTAMP),
                                   CAST(date_trunc('month', last_available_date) AS TIMESTAMP),
                                   INTERVAL 1 MONTH)) AS DATE) AS sales_month
FROM fs_bounds""")

cte("fs_monthly", ["fs_sales"], """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
       min(order_date) AS first_order_date,
       max(order_date) AS last_order_date,
       CAST(count(DISTINCT order_date) AS INTEGER) AS sales_days,
       CAST(count(DISTINCT sales_order_id) AS BIGINT) AS orders_count,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS customers_count,
       CAST(sum(order_quantity) AS BIGINT) AS units_sold,
       sum(gross_amount) AS gross_sales,
       sum(discount_amount) AS discount_amount,
       sum(net_amount) AS net_sales
FROM fs_sales GROUP BY 1""")

cte("fact_sales_monthly", ["fs_spine", "fs_bounds", "fs_monthly"], f"""
SELECT s.sales_month,
       CAST(last_day(s.sales_month) AS DATE) AS month_end_date,
       m.first_order_date, m.last_order_date,
       CAST(COALESCE(m.sales_days, 0) AS INTEGER) AS sales_days,
       CAST(COALESCE(m.orders_count, 0) AS BIGINT) AS orders_count,
       CAST(COALESCE(m.customers_count, 0) AS BIGINT) AS customers_count,
       CAST(COALESCE(m.units_sold, 0) AS BIGINT) AS units_sold,
       CAST(COALESCE(m.gross_sales, 0) AS DECIMAL(19,4)) AS gross_sales,
       CAST(COALESCE(m.discount_amount, 0) AS DECIMAL(19,4)) AS discount_amount,
       CAST(COALESCE(m.net_sales, 0) AS DECIMAL(19,4)) AS net_sales,
       CASE WHEN COALESCE(m.orders_count, 0) = 0 THEN CAST(0 AS DECIMAL(19,4))
            ELSE {div4('m.net_sales', 'm.orders_count')} END AS average_order_value,
       b.first_available_date, b.last_available_date,
       (b.first_available_date <= s.sales_month
        AND b.last_available_date >= CAST(last_day(s.sales_month) AS DATE)) AS is_complete_month
FROM fs_spine s CROSS JOIN fs_bounds b LEFT JOIN fs_monthly m USING (sales_month)""")

cte("dd_limits", ["stg_salesorderheader", "stg_salesorderdetail"], f"""
SELECT CAST(date_trunc('year', min(d)) AS DATE) AS start_date,
       greatest(make_date(CAST(year({AS_OF}) + {FUTURE_YEARS} AS INTEGER), 12, 31),
                make_date(CAST(year(max(d)) AS INTEGER), 12, 31)) AS end_date
FROM (SELECT CAST(order_date AS DATE) AS d FROM stg_salesorderheader
      UNION ALL SELECT CAST(due_date AS DATE) FROM stg_salesorderheader
      UNION ALL SELECT CAST(ship_date AS DATE) FROM stg_salesorderheader
      UNION ALL SELECT CAST(line_ship_date AS DATE) FROM stg_salesorderdetail) x
WHERE d IS NOT NULL""")

_MONTHS = ", ".join(f"'{m}'" for m in [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"])
_DAYS = ", ".join(f"'{d}'" for d in [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo"])

cte("dim_date", ["dd_limits"], f"""
SELECT {_date_key('full_date')} AS date_id,
       full_date,
       CAST(year(full_date) AS INTEGER) AS year_number,
       CASE WHEN month(full_date) <= 6 THEN 1 ELSE 2 END AS semester_number,
       CAST(quarter(full_date) AS INTEGER) AS quarter_number,
       CAST(year(full_date) AS VARCHAR) || '-Q' || CAST(quarter(full_date) AS VARCHAR)
         AS year_quarter,
       CAST(month(full_date) AS INTEGER) AS month_number,
       [{_MONTHS}][month(full_date)] AS month_name,
       strftime(full_date, '%Y-%m') AS year_month,
       CAST(weekofyear(full_date) AS INTEGER) AS iso_week_number,
       CAST(isoyear(full_date) AS INTEGER) AS iso_week_year,
       CAST(isoyear(full_date) AS VARCHAR) || '-W'
         || lpad(CAST(weekofyear(full_date) AS VARCHAR), 2, '0') AS year_iso_week,
       CAST(day(full_date) AS INTEGER) AS day_of_month,
       CAST(isodow(full_date) AS INTEGER) AS day_of_week_number,
       [{_DAYS}][isodow(full_date)] AS day_of_week_name,
       isodow(full_date) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP),
                                         CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
               AS full_date
      FROM dd_limits)""")

cte("dim_customer", ["stg_customer", "stg_person", "stg_store"], """
SELECT c.customer_id, c.person_id, c.store_id, c.territory_id,
       concat_ws(' ', p.first_name, p.middle_name, p.last_name) AS person_name,
       s.store_name,
       CASE WHEN c.person_id IS NOT NULL AND c.store_id IS NOT NULL THEN 'Store with person'
            WHEN c.person_id IS NOT NULL THEN 'Person'
            WHEN c.store_id IS NOT NULL THEN 'Store'
            ELSE 'Unknown' END AS customer_type,
       c.row_guid, c.modified_at, c._loaded_at, c._source_table
FROM stg_customer c
LEFT JOIN stg_person p ON c.person_id = p.business_entity_id
LEFT JOIN stg_store s ON c.store_id = s.business_entity_id""")

cte("dim_sales_person", ["stg_salesperson", "stg_employee", "stg_person"], """
SELECT sp.business_entity_id AS sales_person_id, sp.territory_id,
       p.first_name, p.middle_name, p.last_name,
       substring(concat_ws(' ', p.first_name, p.middle_name, p.last_name), 1, 152) AS full_name,
       e.job_title, e.hire_date, e.is_salaried, e.is_current,
       sp.sales_quota, sp.bonus, sp.commission_pct,
       greatest(sp.modified_at, e.modified_at, p.modified_at) AS modified_at
FROM stg_salesperson sp
LEFT JOIN stg_employee e ON sp.business_entity_id = e.business_entity_id
LEFT JOIN stg_person p ON sp.business_entity_id = p.business_entity_id""")

cte("dim_product", ["stg_product"], """
SELECT product_id, product_name, product_number, is_manufactured, is_finished_good,
       color, size, size_unit_measure_code, weight, weight_unit_measure_code,
       product_line, product_class, product_style,
       safety_stock_level, reorder_point, days_to_manufacture,
       standard_cost, list_price, product_subcategory_id, product_model_id,
       sell_start_date, sell_end_date, discontinued_date
FROM stg_product""")

cte("dim_sales_territory", ["stg_salesterritory"], """
SELECT territory_id, territory_name, country_region_code, territory_group,
       row_guid, modified_at, _loaded_at, _source_table
FROM stg_salesterritory""")

cte("dim_special_offer", ["stg_specialoffer"], """
SELECT special_offer_id, special_offer_description, discount_percentage, offer_type,
       offer_category, start_date, end_date, minimum_quantity, maximum_quantity, modified_at
FROM stg_specialoffer""")

cte("mart_sales_details", ["fact_sales", "dim_product", "dim_customer", "dim_sales_person",
                           "dim_sales_territory", "dim_special_offer"], """
SELECT f.sales_order_detail_id, f.sales_order_id, f.order_date_id, f.due_date_id,
       f.ship_date_id,
       p.product_name, p.product_number, p.product_subcategory_id, p.product_model_id,
       p.color AS product_color, p.size AS product_size, p.product_line, p.product_class,
       p.product_style,
       COALESCE(c.store_name, c.person_name, 'Unknown') AS customer_name,
       c.customer_type,
       sp.full_name AS sales_person_name, sp.job_title AS sales_person_job_title,
       t.territory_name, t.country_region_code, t.territory_group,
       o.special_offer_description, o.offer_type, o.offer_category, o.discount_percentage,
       f.order_status, f.is_online_order, f.order_quantity, f.unit_price,
       f.unit_price_discount, f.gross_amount, f.discount_amount, f.net_amount,
       f.carrier_tracking_number, f.modified_at
FROM fact_sales f
LEFT JOIN dim_product p ON f.product_id = p.product_id
LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
LEFT JOIN dim_sales_person sp ON f.sales_person_id = sp.sales_person_id
LEFT JOIN dim_sales_territory t ON f.territory_id = t.territory_id
LEFT JOIN dim_special_offer o ON f.special_offer_id = o.special_offer_id""")


# ---------------------------------------------------------------- quality
def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def rule_count_sql(rule) -> str:
    head = (f"SELECT '{rule.rule_id}' AS rule_id, '{rule.kind}' AS kind, '{rule.model}' AS model, "
            f"'{rule.column}' AS column_name, '{rule.severity}' AS severity, ")
    c = rule.column
    if rule.kind == "not_null":
        return head + f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {rule.model}"
    if rule.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in rule.values)
        return head + (f"CAST(count(DISTINCT CASE WHEN {c} NOT IN ({vals}) THEN {c} END) AS BIGINT)"
                       f" AS failures FROM {rule.model}")
    if rule.kind == "unique":
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {rule.model} "
                       f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    if rule.kind == "relationships":
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {rule.model} ch "
                       f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {rule.to_model} pa "
                       f"WHERE pa.{rule.to_column} = ch.{c})")
    raise ValueError(rule.kind)


def rule_counts_sql(rules) -> str:
    body = "\nUNION ALL\n".join(rule_count_sql(r) for r in rules)
    models = sorted({r.model for r in rules} | {r.to_model for r in rules if r.to_model})
    select = (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
              f"ELSE 'fail' END AS status FROM (\n{body}\n)")
    return sql(select, *models)
