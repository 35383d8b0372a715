"""Star-schema model queries (B-INT, B-FACT, B-DATE, B-MONTH, dims, mart)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starwright import oracle as O
from starwright.plans.warehouse import Warehouse
from starwright.registry import register


def _model(name: str):
    def build(spark, sf_dir):
        return Warehouse.from_driver(spark, sf_dir).model(name)
    return build


for _name in [
    "int_sales_order_items", "fact_sales", "dim_date", "dim_customer", "dim_product",
    "dim_sales_territory", "dim_special_offer", "dim_sales_person", "mart_sales_details",
]:
    register(_name, O.sql(f"SELECT * FROM {_name}", _name))(_model(_name))


@register("fact_sales_monthly",
          O.sql("SELECT * FROM fact_sales_monthly ORDER BY sales_month", "fact_sales_monthly"))
def fact_sales_monthly(spark, sf_dir):
    # O-1: a stored table has no order; the read sorts (tiny, one row per month)
    return Warehouse.from_driver(spark, sf_dir).fact_sales_monthly.orderBy("sales_month")


@register("territory_card_totals", O.sql("""
SELECT territory_group,
       CAST(sum(net_amount) AS DECIMAL(38,4)) AS net_sales,
       CAST(count(DISTINCT sales_order_id) AS BIGINT) AS orders
FROM mart_sales_details GROUP BY territory_group""", "mart_sales_details"))
def territory_card_totals(spark, sf_dir):
    """P-21: card totals (net sales, order count) under a territory slicer."""
    mart = Warehouse.from_driver(spark, sf_dir).mart_sales_details
    return mart.groupBy("territory_group").agg(
        F.sum("net_amount").cast("decimal(38,4)").alias("net_sales"),
        F.count_distinct("sales_order_id").cast("bigint").alias("orders"),
    )


@register("mart_preview", O.sql("""
SELECT sales_order_detail_id, customer_name, product_name, net_amount
FROM mart_sales_details ORDER BY sales_order_detail_id LIMIT 10""", "mart_sales_details"))
def mart_preview(spark, sf_dir):
    """O-6: the documented ``limit 10`` preview of the mart (top-k by id)."""
    return Warehouse.from_driver(spark, sf_dir).mart_preview(10).select(
        "sales_order_detail_id", "customer_name", "product_name", "net_amount")


# ----------------------------------------------------------------- staging
def _staging(name):
    def build(spark, sf_dir):
        return Warehouse.from_driver(spark, sf_dir).stg(name)
    build.__doc__ = f"P-x: staging model {name} (rename + typed casts of the raw source)."
    return build


for _name in sorted(_STAGING := [
        "stg_customer", "stg_employee", "stg_person", "stg_product", "stg_salesorderdetail",
        "stg_salesorderheader", "stg_salesperson", "stg_salesterritory", "stg_specialoffer",
        "stg_store"]):
    _src = "stg_salesorderdetail_full" if _name == "stg_salesorderdetail" else _name
    register(_name, O.sql(f"SELECT * FROM {_src}", _src))(_staging(_name))
