"""Q-5: schema contracts of the analytics models.

A contract is the declared column list (names, order-insensitive, and types);
the check compares it with ``df.schema`` — no data is read.  Keys are declared
``bigint``; money ``decimal(p,s)``; timestamps are ``timestamp_ntz`` (session
time zone UTC).  Keys and nulls (Q-6) are measured when a table is written, see
operators.constraints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import _parse_datatype_string

# Declared contracts (table models; the mart and dim_special_offer are views
# without a contract in the reference but are declared for profiling).
CONTRACTS = {
    "dim_customer": "customer_id bigint, person_id bigint, store_id bigint, territory_id int, "
                    "person_name string, store_name string, customer_type string, "
                    "row_guid string, modified_at timestamp_ntz, _loaded_at timestamp_ntz, "
                    "_source_table string",
    "dim_date": "date_id int, full_date date, year_number int, semester_number int, "
                "quarter_number int, year_quarter string, month_number int, month_name string, "
                "year_month string, iso_week_number int, iso_week_year int, "
                "year_iso_week string, day_of_month int, day_of_week_number int, "
                "day_of_week_name string, is_weekend boolean",
    "dim_product": "product_id bigint, product_name string, product_number string, "
                   "is_manufactured boolean, is_finished_good boolean, color string, "
                   "size string, size_unit_measure_code string, weight decimal(8,2), "
                   "weight_unit_measure_code string, product_line string, "
                   "product_class string, product_style string, safety_stock_level smallint, "
                   "reorder_point smallint, days_to_manufacture int, "
                   "standard_cost decimal(19,4), list_price decimal(19,4), "
                   "product_subcategory_id int, product_model_id int, "
                   "sell_start_date timestamp_ntz, sell_end_date timestamp_ntz, "
                   "discontinued_date timestamp_ntz",
    "dim_sales_person": "sales_person_id bigint, territory_id int, first_name string, "
                        "middle_name string, last_name string, full_name string, "
                        "job_title string, hire_date date, is_salaried boolean, "
                        "is_current boolean, sales_quota decimal(19,4), bonus decimal(19,4), "
                        "commission_pct decimal(10,4), modified_at timestamp_ntz",
    "dim_sales_territory": "territory_id int, territory_name string, "
                           "country_region_code string, territory_group string, "
                           "row_guid string, modified_at timestamp_ntz, "
                           "_loaded_at timestamp_ntz, _source_table string",
    "dim_special_offer": "special_offer_id int, special_offer_description string, "
                         "discount_percentage decimal(19,4), offer_type string, "
                         "offer_category string, start_date timestamp_ntz, "
                         "end_date timestamp_ntz, minimum_quantity int, maximum_quantity int, "
                         "modified_at timestamp_ntz",
    "fact_sales": "sales_order_detail_id bigint, sales_order_id bigint, product_id bigint, "
                  "customer_id bigint, sales_person_id bigint, territory_id int, "
                  "special_offer_id int, order_date_id int, due_date_id int, "
                  "ship_date_id int, order_status smallint, is_online_order boolean, "
                  "order_quantity smallint, unit_price decimal(19,4), "
                  "unit_price_discount decimal(19,4), gross_amount decimal(19,4), "
                  "discount_amount decimal(19,4), net_amount decimal(19,4), "
                  "carrier_tracking_number string, modified_at timestamp_ntz",
    "fact_sales_monthly": "sales_month date, month_end_date date, first_order_date date, "
                          "last_order_date date, sales_days int, orders_count bigint, "
                          "customers_count bigint, units_sold bigint, "
                          "gross_sales decimal(19,4), discount_amount decimal(19,4), "
                          "net_sales decimal(19,4), average_order_value decimal(19,4), "
                          "first_available_date date, last_available_date date, "
                          "is_complete_month boolean",
    "mart_sales_details": "sales_order_detail_id bigint, sales_order_id bigint, "
                          "order_date_id int, due_date_id int, ship_date_id int, "
                          "product_name string, product_number string, "
                          "product_subcategory_id int, product_model_id int, "
                          "product_color string, product_size string, product_line string, "
                          "product_class string, product_style string, customer_name string, "
                          "customer_type string, sales_person_name string, "
                          "sales_person_job_title string, territory_name string, "
                          "country_region_code string, territory_group string, "
                          "special_offer_description string, offer_type string, "
                          "offer_category string, discount_percentage decimal(19,4), "
                          "order_status smallint, is_online_order boolean, "
                          "order_quantity smallint, unit_price decimal(19,4), "
                          "unit_price_discount decimal(19,4), gross_amount decimal(19,4), "
                          "discount_amount decimal(19,4), net_amount decimal(19,4), "
                          "carrier_tracking_number string, modified_at timestamp_ntz",
}
ENFORCED = ["dim_customer", "dim_date", "dim_product", "dim_sales_person",
            "dim_sales_territory", "fact_sales", "fact_sales_monthly"]


def declared_columns(model: str) -> list[tuple[str, str]]:
    out = []
    for part in CONTRACTS[model].split(", "):
        name, typ = part.rsplit(" ", 1) if "decimal" not in part else part.split(" ", 1)
        out.append((name.strip(), typ.strip()))
    return out


class ContractError(ValueError):
    pass


def contract_violations(model: str, df: DataFrame) -> list[str]:
    """Differences between ``df.schema`` and the declared contract."""
    declared = {n: _parse_datatype_string(t).simpleString() for n, t in declared_columns(model)}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [f"missing column {c}" for c in declared if c not in actual]
    problems += [f"undeclared column {c}" for c in actual if c not in declared]
    problems += [f"{c}: declared {declared[c]}, got {actual[c]}"
                 for c in declared if c in actual and declared[c] != actual[c]]
    return problems


def enforce(model: str, df: DataFrame) -> DataFrame:
    """Raise :class:`ContractError` when the schema breaks the contract."""
    problems = contract_violations(model, df)
    if problems:
        raise ContractError(f"{model}: " + "; ".join(problems))
    return df
