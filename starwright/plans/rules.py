"""Rule catalogue (declared column rules) and singular business rules.

The declarations mirror the reference's model YAML: 174 ``not_null``, 24
``unique``, 15 ``relationships`` and 9 ``accepted_values`` rules (4 of them
``warn``).  Singular rules (Q-10 … Q-23) are functions returning failing rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.quality import Rule

# The declared column rules of each model, as in the reference.
NOT_NULL = {
    "stg_salesorderheader": "sales_order_id customer_id order_date",
    "stg_salesorderdetail": "sales_order_detail_id sales_order_id product_id order_quantity "
                            "unit_price",
    "stg_customer": "customer_id",
    "stg_person": "business_entity_id person_type first_name last_name",
    "stg_salesterritory": "territory_id territory_name country_region_code territory_group",
    "stg_product": "product_id product_name product_number is_manufactured is_finished_good "
                   "standard_cost list_price sell_start_date",
    "stg_store": "business_entity_id store_name row_guid modified_at _loaded_at _source_table",
    "stg_specialoffer": "special_offer_id special_offer_description discount_percentage "
                        "offer_type offer_category start_date end_date minimum_quantity row_guid "
                        "modified_at _loaded_at _source_table",
    "stg_salesperson": "business_entity_id bonus commission_pct sales_ytd sales_last_year "
                       "row_guid modified_at _loaded_at _source_table",
    "stg_employee": "business_entity_id national_id_number login_id job_title birth_date "
                    "marital_status gender hire_date is_salaried vacation_hours sick_leave_hours "
                    "is_current row_guid modified_at organization_node _loaded_at _source_table",
    "int_sales_order_items": "sales_order_detail_id sales_order_id product_id customer_id "
                             "order_date order_quantity gross_amount discount_amount net_amount",
    "dim_product": "product_id",
    "dim_customer": "customer_id customer_type row_guid modified_at _loaded_at _source_table",
    "dim_sales_territory": "territory_id territory_name country_region_code territory_group "
                           "row_guid modified_at _loaded_at _source_table",
    "dim_date": "date_id full_date year_number semester_number quarter_number year_quarter "
                "month_number month_name year_month iso_week_number iso_week_year year_iso_week "
                "day_of_month day_of_week_number day_of_week_name is_weekend",
    "fact_sales": "sales_order_detail_id sales_order_id product_id customer_id territory_id "
                  "special_offer_id order_date_id due_date_id order_status is_online_order "
                  "order_quantity unit_price unit_price_discount gross_amount discount_amount "
                  "net_amount modified_at",
    "fact_sales_monthly": "sales_month month_end_date sales_days orders_count customers_count "
                          "units_sold gross_sales discount_amount net_sales average_order_value "
                          "first_available_date last_available_date is_complete_month",
    "dim_sales_person": "sales_person_id first_name last_name full_name job_title hire_date "
                        "is_salaried is_current bonus commission_pct modified_at",
    "mart_sales_details": "sales_order_detail_id sales_order_id order_date_id due_date_id "
                          "product_name product_number customer_name customer_type "
                          "territory_name country_region_code territory_group "
                          "special_offer_description offer_type offer_category "
                          "discount_percentage order_status is_online_order order_quantity "
                          "unit_price unit_price_discount gross_amount discount_amount "
                          "net_amount modified_at",
}

UNIQUE = {
    "stg_salesorderheader": "sales_order_id",
    "stg_salesorderdetail": "sales_order_detail_id",
    "stg_customer": "customer_id",
    "stg_person": "business_entity_id",
    "stg_salesterritory": "territory_id",
    "stg_product": "product_id product_number",
    "stg_store": "business_entity_id",
    "stg_specialoffer": "special_offer_id",
    "stg_salesperson": "business_entity_id row_guid",
    "stg_employee": "business_entity_id login_id row_guid",
    "int_sales_order_items": "sales_order_detail_id",
    "dim_product": "product_id",
    "dim_customer": "customer_id",
    "dim_sales_territory": "territory_id",
    "dim_date": "date_id full_date",
    "fact_sales": "sales_order_detail_id",
    "fact_sales_monthly": "sales_month",
    "dim_sales_person": "sales_person_id",
    "mart_sales_details": "sales_order_detail_id",
}

RELATIONSHIPS = [
    ("int_sales_order_items", "sales_order_id", "stg_salesorderheader", "sales_order_id"),
    ("int_sales_order_items", "product_id", "stg_product", "product_id"),
    ("int_sales_order_items", "customer_id", "stg_customer", "customer_id"),
    ("dim_customer", "person_id", "stg_person", "business_entity_id"),
    ("dim_customer", "store_id", "stg_store", "business_entity_id"),
    ("dim_customer", "territory_id", "dim_sales_territory", "territory_id"),
    ("fact_sales", "product_id", "dim_product", "product_id"),
    ("fact_sales", "customer_id", "dim_customer", "customer_id"),
    ("fact_sales", "sales_person_id", "dim_sales_person", "sales_person_id"),
    ("fact_sales", "territory_id", "dim_sales_territory", "territory_id"),
    ("fact_sales", "special_offer_id", "dim_special_offer", "special_offer_id"),
    ("fact_sales", "order_date_id", "dim_date", "date_id"),
    ("fact_sales", "due_date_id", "dim_date", "date_id"),
    ("fact_sales", "ship_date_id", "dim_date", "date_id"),
    ("dim_sales_person", "territory_id", "dim_sales_territory", "territory_id"),
]

ACCEPTED_VALUES = [
    ("stg_person", "person_type", ("EM", "GC", "IN", "SC", "SP", "VC"), "warn"),
    ("stg_employee", "marital_status", ("M", "S"), "warn"),
    ("stg_employee", "gender", ("F", "M"), "warn"),
    ("dim_customer", "customer_type", ("Person", "Store", "Store with person"), "error"),
    ("dim_sales_territory", "territory_group", ("Europe", "North America", "Pacific"), "warn"),
    ("dim_date", "semester_number", (1, 2), "error"),
    ("dim_date", "quarter_number", (1, 2, 3, 4), "error"),
    ("dim_date", "month_number", tuple(range(1, 13)), "error"),
    ("dim_date", "day_of_week_number", tuple(range(1, 8)), "error"),
]


def catalogue() -> list[Rule]:
    rules = [Rule("not_null", m, c) for m, cols in NOT_NULL.items() for c in cols.split()]
    rules += [Rule("unique", m, c) for m, cols in UNIQUE.items() for c in cols.split()]
    rules += [Rule("relationships", m, c, to_model=tm, to_column=tc)
              for m, c, tm, tc in RELATIONSHIPS]
    rules += [Rule("accepted_values", m, c, severity=s, values=v)
              for m, c, v, s in ACCEPTED_VALUES]
    return rules


def rules_for_layer(layer_models: list[str]) -> list[Rule]:
    return [r for r in catalogue() if r.model in layer_models]


# ------------------------------------------------------------ singular rules
def employee_dates(employees: DataFrame, as_of: dt.date) -> DataFrame:
    today = F.lit(as_of)
    return employees.where(
        (F.col("birth_date") > today) | (F.col("hire_date") > today)
        | (F.col("hire_date") <= F.col("birth_date"))
    ).select("business_entity_id", "birth_date", "hire_date")


def employee_hours(employees: DataFrame) -> DataFrame:
    return employees.where((F.col("vacation_hours") < 0) | (F.col("sick_leave_hours") < 0)) \
        .select("business_entity_id", "vacation_hours", "sick_leave_hours")


def monthly_missing_months(monthly: DataFrame) -> DataFrame:
    """Q-12: expected months between the model's first and last month, absent."""
    bounds = monthly.agg(F.min("sales_month").alias("a"), F.max("sales_month").alias("b"))
    expected = bounds.select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("sales_month")
    )
    actual = monthly.select("sales_month")
    return expected.join(actual, ["sales_month"], "left_anti") \
        .select(F.col("sales_month").alias("missing_sales_month"))


def monthly_negative_metrics(monthly: DataFrame) -> DataFrame:
    cols = ["orders_count", "customers_count", "units_sold", "gross_sales", "discount_amount",
            "net_sales", "average_order_value"]
    cond = None
    for c in cols:
        cond = (F.col(c) < 0) if cond is None else cond | (F.col(c) < 0)
    return monthly.where(cond)


def monthly_reconciles(monthly: DataFrame, fact: DataFrame) -> DataFrame:
    """Q-14: monthly totals against fact totals (two one-row aggregates)."""
    m = monthly.agg(
        F.sum("net_sales").cast("decimal(38,4)").alias("monthly_net_sales"),
        F.sum("orders_count").cast("bigint").alias("monthly_orders_count"),
        F.sum("units_sold").cast("bigint").alias("monthly_units_sold"),
    )
    f = fact.agg(
        F.sum("net_amount").cast("decimal(38,4)").alias("fact_net_sales"),
        F.count_distinct("sales_order_id").cast("bigint").alias("fact_orders_count"),
        F.sum("order_quantity").cast("bigint").alias("fact_units_sold"),
    )
    return m.crossJoin(f).where(
        (F.abs(F.col("monthly_net_sales") - F.col("fact_net_sales")) > F.lit(0.01))
        | (F.col("monthly_orders_count") != F.col("fact_orders_count"))
        | (F.col("monthly_units_sold") != F.col("fact_units_sold"))
    ).select("monthly_net_sales", "fact_net_sales", "monthly_orders_count",
             "fact_orders_count", "monthly_units_sold", "fact_units_sold")


def fact_net_amount(fact: DataFrame) -> DataFrame:
    diff = F.abs(F.col("net_amount") - (F.col("gross_amount") - F.col("discount_amount")))
    return fact.where(diff > F.lit(0.0001).cast("decimal(5,4)")) \
        .select("sales_order_detail_id", "gross_amount", "discount_amount", "net_amount")


def fact_quantity(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("order_quantity") <= 0).select("sales_order_detail_id",
                                                           "order_quantity")


def fact_unit_price(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("unit_price") <= 0).select("sales_order_detail_id", "unit_price")


def order_subtotals(header: DataFrame, items: DataFrame) -> DataFrame:
    """Q-18: header subtotal vs Σ line net; missing on either side or off by > 0.01.

    Item totals are pre-aggregated per order (partial aggregation before the
    shuffle), then full-outer joined to the header on the order key.
    """
    totals = items.groupBy("sales_order_id").agg(
        F.sum("net_amount").cast("decimal(38,4)").alias("calculated_subtotal")
    )
    o = header.select("sales_order_id", F.col("subtotal").alias("expected_subtotal")).alias("o")
    t = totals.alias("t")
    joined = o.join(t, F.col("o.sales_order_id") == F.col("t.sales_order_id"), "full_outer")
    difference = F.abs(
        F.coalesce(F.col("expected_subtotal"), F.lit(0))
        - F.coalesce(F.col("calculated_subtotal"), F.lit(0))
    )
    return joined.select(
        F.coalesce(F.col("o.sales_order_id"), F.col("t.sales_order_id")).alias("sales_order_id"),
        "expected_subtotal",
        "calculated_subtotal",
        difference.cast("decimal(38,4)").alias("difference"),
    ).where(
        F.col("expected_subtotal").isNull() | F.col("calculated_subtotal").isNull()
        | (F.col("difference") > F.lit(0.01))
    )


def salesperson_amounts(sp: DataFrame) -> DataFrame:
    return sp.where(
        (F.col("sales_quota") < 0) | (F.col("bonus") < 0) | (F.col("sales_ytd") < 0)
        | (F.col("sales_last_year") < 0)
    ).select("business_entity_id", "sales_quota", "bonus", "sales_ytd", "sales_last_year")


def salesperson_commission(sp: DataFrame) -> DataFrame:
    return sp.where((F.col("commission_pct") < 0) | (F.col("commission_pct") > 1)) \
        .select("business_entity_id", "commission_pct")


def offer_dates(offers: DataFrame) -> DataFrame:
    return offers.where(F.col("end_date") < F.col("start_date")) \
        .select("special_offer_id", "special_offer_description", "start_date", "end_date")


def offer_discount(offers: DataFrame) -> DataFrame:
    return offers.where((F.col("discount_percentage") < 0) | (F.col("discount_percentage") > 1)) \
        .select("special_offer_id", "special_offer_description", "discount_percentage")


def offer_quantities(offers: DataFrame) -> DataFrame:
    return offers.where(
        (F.col("minimum_quantity") < 0)
        | (F.col("maximum_quantity").isNotNull()
           & (F.col("maximum_quantity") < F.col("minimum_quantity")))
    ).select("special_offer_id", "special_offer_description", "minimum_quantity",
             "maximum_quantity")


# name → (function, input models, stores failures)
SINGULAR = {
    "assert_employee_dates_are_valid": (employee_dates, ["stg_employee"], True),
    "assert_employee_hours_are_non_negative": (employee_hours, ["stg_employee"], True),
    "assert_fact_sales_monthly_has_continuous_months": (
        monthly_missing_months, ["fact_sales_monthly"], False),
    "assert_fact_sales_monthly_metrics_are_valid": (
        monthly_negative_metrics, ["fact_sales_monthly"], False),
    "assert_fact_sales_monthly_reconciles": (
        monthly_reconciles, ["fact_sales_monthly", "fact_sales"], False),
    "assert_fact_sales_net_amount_is_valid": (fact_net_amount, ["fact_sales"], True),
    "assert_fact_sales_quantity_is_positive": (fact_quantity, ["fact_sales"], True),
    "assert_fact_sales_unit_price_is_positive": (fact_unit_price, ["fact_sales"], True),
    "assert_sales_order_subtotals_match": (
        order_subtotals, ["stg_salesorderheader", "int_sales_order_items"], True),
    "assert_salesperson_amounts_are_non_negative": (
        salesperson_amounts, ["stg_salesperson"], True),
    "assert_salesperson_commission_is_valid": (salesperson_commission, ["stg_salesperson"], True),
    "assert_special_offer_dates_are_valid": (offer_dates, ["stg_specialoffer"], True),
    "assert_special_offer_discount_is_valid": (offer_discount, ["stg_specialoffer"], True),
    "assert_special_offer_quantities_are_valid": (offer_quantities, ["stg_specialoffer"], True),
}


def singular_failures(name: str, wh) -> DataFrame:
    fn, inputs, _ = SINGULAR[name]
    args = [wh.model(m) for m in inputs]
    if fn is employee_dates:
        return fn(*args, wh.as_of)
    return fn(*args)
