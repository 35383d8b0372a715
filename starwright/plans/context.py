"""Measures under a filter context: any grain, any slicer, any filter removed.

A report asks for the same measures at many grains, below slicers, and divides
them by themselves with one dimension's filters removed.  Sums roll up from any
finer grain; distinct counts don't, so they are kept as bits (``plans/cells.py``).
``cells`` reads the fact once; every question after that unites bits and adds sums
of the written cells, and the fact is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.columns import ratio
from starwright.plans.cells import at_grain, cells, unite  # noqa: F401
from starwright.plans.measures import derived, join_null_safe

# measures whose share of the total a report shows
SHARES = ["net_sales", "orders"]


def measures(cells: DataFrame, keys: Sequence[str], slicer: Column | None = None,
             removed: Sequence[str] = ()) -> DataFrame:
    """The measures of each combination of ``keys`` among the cells that ``slicer``
    leaves.

    With ``removed`` (some of the keys; the slicer's own keys may be there too),
    ``share_*`` divide by the same measure with the filters of those keys removed
    and the remaining keys kept, ``*_index`` set the average ticket and the sales a
    customer against theirs there, and ``rank_net_sales`` is dense within the
    remaining keys.  A slicer on a removed key doesn't reach the divisor, as a
    report's doesn't: the cells it reads are all of them."""
    kept = cells if slicer is None else cells.where(slicer)
    got = derived(at_grain(kept, keys))
    if not removed:
        return got
    rest = [k for k in keys if k not in removed]
    # the bits united for the keys once serve both: the exchange is the same
    base = at_grain(unite(cells, keys) if slicer is None else cells, rest)
    base = base.select(
        *rest, *(F.col(n).alias(f"__all_{n}") for n in SHARES),
        ratio("net_sales", "orders").alias("__all_ticket"),
        ratio("net_sales", "active_customers").alias("__all_customer"))
    # without remaining keys the divisor is one row
    got = join_null_safe(got, base, rest) if rest else got.crossJoin(F.broadcast(base))
    out = [c for c in got.columns if not c.startswith("__all_")]
    got = got.select(
        *out, *(ratio(n, f"__all_{n}").alias(f"share_{n}") for n in SHARES),
        F.try_divide("avg_ticket", "__all_ticket").alias("ticket_index"),
        F.try_divide("sales_per_customer", "__all_customer").alias("customer_index"))
    if not rest:
        return got
    # the members of one combination of the remaining keys, e.g. a month's territories
    order = Window.partitionBy(*rest).orderBy(F.coalesce("net_sales", F.lit(0)).desc())
    return got.withColumn("rank_net_sales", F.dense_rank().over(order))


def context_cells(fact: DataFrame, dim_territory: DataFrame) -> DataFrame:
    """The fact's cells for the keys that slicers and visuals share.  They are made
    by territory id and month, and get the names and the year afterwards."""
    month = (F.col("order_date_id") / 100).cast("int")
    made = cells(fact.withColumn("__month", month), ["territory_id", "__month"])
    return (made.join(dim_territory.select("territory_id", "territory_name", "territory_group"),
                      "territory_id", "left")
            .withColumn("year_number", (F.col("__month") / 100).cast("int"))
            .withColumn("month_number", F.col("__month") % 100)
            .drop("territory_id", "__month"))


CONTEXT_KEYS = ["territory_group", "territory_name", "year_number", "month_number"]
