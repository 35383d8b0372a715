"""Q-6: key and null constraints of the table models, checked when they are written.

``checked_write`` counts rows and nulls in the pass that writes (an
``Observation``), then checks every key of the written table in one shuffle: each
row gives a (constraint, key) pair for its own key and for each key that it
refers to, each parent row the keys that are referred to, and a pair's counts
tell a repeated key and a child without parent.  Pairs shrink per task before
they are dealt out, so a key held by a third of all rows is a few rows there.
A table with violations is never published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

# The declared keys and the columns that hold no nulls.
PRIMARY = {
    "dim_customer": "customer_id", "dim_date": "date_id", "dim_product": "product_id",
    "dim_sales_person": "sales_person_id", "dim_sales_territory": "territory_id",
    "fact_sales": "sales_order_detail_id", "fact_sales_monthly": "sales_month",
}
FOREIGN = {
    "dim_customer": {"territory_id": ("dim_sales_territory", "territory_id")},
    "dim_sales_person": {"territory_id": ("dim_sales_territory", "territory_id")},
    "fact_sales": {
        "product_id": ("dim_product", "product_id"),
        "customer_id": ("dim_customer", "customer_id"),
        "sales_person_id": ("dim_sales_person", "sales_person_id"),
        "territory_id": ("dim_sales_territory", "territory_id"),
        "special_offer_id": ("dim_special_offer", "special_offer_id"),
        "order_date_id": ("dim_date", "date_id"),
        "due_date_id": ("dim_date", "date_id"),
        "ship_date_id": ("dim_date", "date_id"),
    },
}
NOT_NULL = {model: columns.split() for model, columns in {
    "dim_product": "product_id product_name product_number",
    "dim_customer": "customer_id customer_type row_guid modified_at _loaded_at _source_table",
    "dim_sales_territory": "territory_id territory_name country_region_code territory_group "
                           "row_guid modified_at _loaded_at _source_table",
    "dim_sales_person": "sales_person_id first_name last_name full_name job_title hire_date "
                        "is_salaried is_current bonus commission_pct modified_at",
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
}.items()}

RESULT = "model string, constraint_name string, kind string, violations bigint"


class ConstraintError(ValueError):
    """A written table breaks its constraints; it was not published."""


def null_counts(model: str) -> list:
    """A count of nulls for each column that holds none, named after it."""
    return [F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL.get(model, [])]


def key_violations(model: str, df: DataFrame, parents: Callable[[str], DataFrame]) -> DataFrame:
    """Rows of ``RESULT`` for the keys of a table: rows of a repeated or null primary
    key beyond the first, and rows with a foreign key that no parent has (a null
    one refers to nothing)."""
    primary, foreign = PRIMARY.get(model), FOREIGN.get(model, {})
    declared = ([(f"{model}_{primary}_pk", primary)] if primary else []) \
        + [(f"{model}_{c}_fk", c) for c in foreign]
    if not declared:
        return df.sparkSession.createDataFrame([], RESULT)
    place = {name: i for i, (name, _) in enumerate(declared)}
    sides = [(df, declared, 1)]
    for parent in sorted({p for p, _ in foreign.values()}):
        sides.append((parents(parent), [(f"{model}_{c}_fk", key)
                                        for c, (p, key) in foreign.items() if p == parent], 0))
    # whole numbers and dates stay fixed-width, which a hash aggregate keeps in place
    types = {rows.schema[c].dataType for rows, columns, _ in sides for _, c in columns}
    narrow = all(isinstance(t, IntegralType | DateType) for t in types)

    def key(rows: DataFrame, c: str) -> Column:
        if not narrow:
            return F.col(c).cast("string")
        dated = isinstance(rows.schema[c].dataType, DateType)
        return (F.unix_date(c) if dated else F.col(c)).cast("bigint")

    def pairs(rows: DataFrame, columns: list[tuple[str, str]], own: int) -> DataFrame:
        made = F.array(*(F.struct(F.lit(place[name]).cast("tinyint").alias("place"),
                                  key(rows, c).alias("key")) for name, c in columns))
        return rows.select(F.inline(made)).select(
            "place", "key", F.lit(own).alias("child"), F.lit(1 - own).alias("parent"))

    both = reduce(DataFrame.unionAll, (pairs(*side) for side in sides))
    counts = both.groupBy("place", "key").agg(
        F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    is_primary = F.col("place") == (0 if primary else -1)
    broken = F.when(is_primary & F.col("key").isNull(), F.col("child")) \
        .when(is_primary, F.col("child") - 1) \
        .when(F.col("key").isNotNull() & (F.col("parent") == 0), F.col("child")).otherwise(0)
    found = counts.groupBy("place").agg(F.sum(broken).alias("violations"))
    names = df.sparkSession.createDataFrame(
        [(i, n, "primary_key" if n.endswith("_pk") else "foreign_key")
         for n, i in place.items()], "place tinyint, name string, kind string")
    return names.join(found, "place", "left").select(
        F.lit(model).alias("model"), F.col("name").alias("constraint_name"), "kind",
        F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def constraint_violations(model: str, df: DataFrame, parents: Callable[[str], DataFrame]
                          ) -> DataFrame:
    """Rows of ``RESULT`` for all constraints of a table."""
    nulls = df.agg(*null_counts(model)).select(F.inline(F.array(*(
        F.struct(F.lit(model).alias("model"), F.lit(f"{model}_{c}_not_null").alias(
            "constraint_name"), F.lit("not_null").alias("kind"), F.col(c).alias("violations"))
        for c in NOT_NULL[model]))))
    return nulls.unionByName(key_violations(model, df, parents))


def checked_write(model: str, df: DataFrame, folder: str, parents: Callable[[str], DataFrame]
                  ) -> tuple[str, list[tuple[str, int]]]:
    """Write a table to a new folder below ``folder`` and measure its constraints.
    Returns the path and the broken constraints with their violations; whoever
    publishes the table decides on them."""
    path = f"{folder}/v-{uuid.uuid4().hex}"
    nulls = null_counts(model)
    seen = Observation(f"constraints {model}")
    (df.observe(seen, F.count(F.lit(1)).alias("__rows"), *nulls) if nulls else df) \
        .write.mode("errorifexists").parquet(path)
    measured = seen.get if nulls else {}
    broken = [(f"{model}_{c}_not_null", int(measured[c])) for c in NOT_NULL.get(model, [])
              if measured.get(c)]
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    broken += [(r["constraint_name"], r["violations"])       # a row for each declared key
               for r in key_violations(model, written, parents).collect() if r["violations"]]
    return path, broken
