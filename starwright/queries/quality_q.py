"""Quality queries: generic rule counts, failing rows, singular rules, freshness."""

from __future__ import annotations

from starwright import oracle as O
from starwright.operators import quality
from starwright.plans import freshness, rules
from starwright.plans.warehouse import Warehouse
from starwright.registry import register


def _wh(spark, sf_dir) -> Warehouse:
    return Warehouse.from_driver(spark, sf_dir)


@register("quality_rule_counts", O.rule_counts_sql(rules.catalogue()))
def quality_rule_counts(spark, sf_dir):
    """Q-1…Q-4: failure count and status of all 222 declared column rules."""
    wh = _wh(spark, sf_dir)
    return quality.rule_counts(rules.catalogue(), wh.model)


@register("accepted_values_territory_group", O.sql("""
SELECT territory_group AS value_field, CAST(count(*) AS BIGINT) AS n_records
FROM dim_sales_territory
WHERE territory_group NOT IN ('Europe', 'North America', 'Pacific')
GROUP BY territory_group""", "dim_sales_territory"))
def accepted_values_territory_group(spark, sf_dir):
    """Q-4 failing rows (a warn rule that fails on the driver data)."""
    wh = _wh(spark, sf_dir)
    return quality.accepted_values_failures(
        wh.dim_sales_territory, "territory_group", ("Europe", "North America", "Pacific")
    ).selectExpr("value_field", "CAST(n_records AS BIGINT) AS n_records")


@register("relationships_fact_sales_ship_date", O.sql("""
SELECT f.ship_date_id AS from_field FROM fact_sales f
WHERE f.ship_date_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.ship_date_id)""",
                                                     "fact_sales", "dim_date"))
def relationships_fact_sales_ship_date(spark, sf_dir):
    """Q-3 / J-18 failing rows: fact ship-date keys missing from the calendar."""
    wh = _wh(spark, sf_dir)
    return quality.relationships_failures(wh.fact_sales, "ship_date_id", wh.dim_date, "date_id")


# -------------------------------------------------------------- singular
_SINGULAR_SQL = {
    "assert_employee_dates_are_valid": (f"""
SELECT business_entity_id, birth_date, hire_date FROM stg_employee
WHERE birth_date > {O.AS_OF} OR hire_date > {O.AS_OF} OR hire_date <= birth_date""",
                                        ["stg_employee"]),
    "assert_employee_hours_are_non_negative": ("""
SELECT business_entity_id, vacation_hours, sick_leave_hours FROM stg_employee
WHERE vacation_hours < 0 OR sick_leave_hours < 0""", ["stg_employee"]),
    "assert_fact_sales_monthly_has_continuous_months": ("""
SELECT e.sales_month AS missing_sales_month
FROM (SELECT CAST(unnest(generate_series(CAST(min(sales_month) AS TIMESTAMP),
                                         CAST(max(sales_month) AS TIMESTAMP),
                                         INTERVAL 1 MONTH)) AS DATE) AS sales_month
      FROM fact_sales_monthly) e
LEFT JOIN fact_sales_monthly a USING (sales_month)
WHERE a.sales_month IS NULL""", ["fact_sales_monthly"]),
    "assert_fact_sales_monthly_metrics_are_valid": ("""
SELECT * FROM fact_sales_monthly
WHERE orders_count < 0 OR customers_count < 0 OR units_sold < 0 OR gross_sales < 0
   OR discount_amount < 0 OR net_sales < 0 OR average_order_value < 0""",
                                                    ["fact_sales_monthly"]),
    "assert_fact_sales_monthly_reconciles": ("""
SELECT m.net_sales AS monthly_net_sales, f.net_sales AS fact_net_sales,
       m.orders_count AS monthly_orders_count, f.orders_count AS fact_orders_count,
       m.units_sold AS monthly_units_sold, f.units_sold AS fact_units_sold
FROM (SELECT CAST(sum(net_sales) AS DECIMAL(38,4)) AS net_sales,
             CAST(sum(orders_count) AS BIGINT) AS orders_count,
             CAST(sum(units_sold) AS BIGINT) AS units_sold FROM fact_sales_monthly) m
CROSS JOIN (SELECT CAST(sum(net_amount) AS DECIMAL(38,4)) AS net_sales,
                   CAST(count(DISTINCT sales_order_id) AS BIGINT) AS orders_count,
                   CAST(sum(order_quantity) AS BIGINT) AS units_sold FROM fact_sales) f
WHERE abs(m.net_sales - f.net_sales) > 0.01 OR m.orders_count <> f.orders_count
   OR m.units_sold <> f.units_sold""", ["fact_sales_monthly", "fact_sales"]),
    "assert_fact_sales_net_amount_is_valid": ("""
SELECT sales_order_detail_id, gross_amount, discount_amount, net_amount FROM fact_sales
WHERE abs(net_amount - (gross_amount - discount_amount)) > 0.0001""", ["fact_sales"]),
    "assert_fact_sales_quantity_is_positive": ("""
SELECT sales_order_detail_id, order_quantity FROM fact_sales WHERE order_quantity <= 0""",
                                               ["fact_sales"]),
    "assert_fact_sales_unit_price_is_positive": ("""
SELECT sales_order_detail_id, unit_price FROM fact_sales WHERE unit_price <= 0""",
                                                 ["fact_sales"]),
    "assert_sales_order_subtotals_match": ("""
SELECT * FROM (
  SELECT COALESCE(o.sales_order_id, t.sales_order_id) AS sales_order_id,
         o.subtotal AS expected_subtotal,
         CAST(t.calculated_subtotal AS DECIMAL(38,4)) AS calculated_subtotal,
         CAST(abs(COALESCE(o.subtotal, 0) - COALESCE(t.calculated_subtotal, 0))
              AS DECIMAL(38,4)) AS difference
  FROM stg_salesorderheader o
  FULL OUTER JOIN (SELECT sales_order_id, sum(net_amount) AS calculated_subtotal
                   FROM int_sales_order_items GROUP BY sales_order_id) t
    ON o.sales_order_id = t.sales_order_id) v
WHERE expected_subtotal IS NULL OR calculated_subtotal IS NULL OR difference > 0.01""",
                                           ["stg_salesorderheader", "int_sales_order_items"]),
    "assert_salesperson_amounts_are_non_negative": ("""
SELECT business_entity_id, sales_quota, bonus, sales_ytd, sales_last_year FROM stg_salesperson
WHERE sales_quota < 0 OR bonus < 0 OR sales_ytd < 0 OR sales_last_year < 0""",
                                                    ["stg_salesperson"]),
    "assert_salesperson_commission_is_valid": ("""
SELECT business_entity_id, commission_pct FROM stg_salesperson
WHERE commission_pct < 0 OR commission_pct > 1""", ["stg_salesperson"]),
    "assert_special_offer_dates_are_valid": ("""
SELECT special_offer_id, special_offer_description, start_date, end_date FROM stg_specialoffer
WHERE end_date < start_date""", ["stg_specialoffer"]),
    "assert_special_offer_discount_is_valid": ("""
SELECT special_offer_id, special_offer_description, discount_percentage FROM stg_specialoffer
WHERE discount_percentage < 0 OR discount_percentage > 1""", ["stg_specialoffer"]),
    "assert_special_offer_quantities_are_valid": ("""
SELECT special_offer_id, special_offer_description, minimum_quantity, maximum_quantity
FROM stg_specialoffer
WHERE minimum_quantity < 0 OR (maximum_quantity IS NOT NULL AND maximum_quantity < minimum_quantity)
""", ["stg_specialoffer"]),
}


def _singular(name):
    def build(spark, sf_dir):
        return rules.singular_failures(name, _wh(spark, sf_dir))
    build.__doc__ = f"Singular rule {name}: failing rows."
    return build


for _name, (_select, _deps) in _SINGULAR_SQL.items():
    register(_name, O.sql(_select, *_deps))(_singular(_name))


@register("source_freshness", freshness.oracle_sql())
def source_freshness(spark, sf_dir):
    """Q-FRESH: age of the newest load per source against the warn/error policy."""
    wh = _wh(spark, sf_dir)
    return freshness.source_freshness(wh.raw, freshness.DEFAULT_CHECKED_AT)
