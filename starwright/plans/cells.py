"""Cells: sums and distinct counts of the fact that roll up to any coarser grain.

Sums roll up, distinct counts don't, so a cell keeps the bits of the ids seen in
it: one 64-bit word for each combination of keys and each 64 ids in a row, with
the sums beside the words of the first kind of id.  A word is a fixed-width value
of a hash aggregate, so a cell of one id costs one row, not a bitmap of a whole
bucket, and there are never more words than lines times kinds of id.

Ids are whole numbers, so the counts are exact.  A null id counts in the sums and
in no distinct count; a null key is the blank member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,4)"

# measure → the id whose distinct values it counts
COUNTED = {"orders": "sales_order_id", "active_customers": "customer_id",
           "products_sold": "product_id"}
SUMS = ["net_sales", "units", "gross_value", "line_count"]


def cells(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``lines`` (the fact's columns and ``keys``) → keys, ``kind``, ``bucket``,
    ``bits`` and the sums; ``kind`` is a place in COUNTED.  A line becomes one row for
    each id it counts; those of one cell and bucket meet before the shuffle."""
    sums = {"net_sales": F.col("net_amount"), "units": F.col("order_quantity").cast("bigint"),
            "gross_value": F.col("unit_price") * F.col("order_quantity"),
            "line_count": F.lit(1).cast("bigint")}
    ids = F.array(*(F.struct(F.lit(kind).cast("tinyint").alias("kind"),
                             F.col(c).cast("bigint").alias("id"))
                    for kind, c in enumerate(COUNTED.values())))
    rows = lines.select(*keys, *(e.alias(n) for n, e in sums.items()), F.explode(ids).alias("x"))
    rows = rows.select(*keys, "x.kind", "x.id",
                       *(F.when(F.col("x.kind") == 0, F.col(n)).alias(n) for n in SUMS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                          F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    return rows.groupBy(*keys, "kind", F.shiftright("id", 6).alias("bucket")).agg(
        F.bit_or(bit).alias("bits"), *(F.sum(n).alias(n) for n in SUMS))


def unite(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The cells of some of the keys: words of a bucket united, sums added."""
    return cells.groupBy(*keys, "kind", "bucket").agg(
        F.bit_or("bits").alias("bits"), *(F.sum(n).alias(n) for n in SUMS))


def at_grain(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The base measures for each combination of ``keys`` among the cells (one row
    without keys): words of a bucket are united first, then counted and added."""
    money = {"net_sales": MONEY, "gross_value": MONEY}
    united = unite(cells, keys)
    counts = [F.coalesce(F.sum(F.when((F.col("kind") == kind) & F.col("bucket").isNotNull(),
                                      F.bit_count("bits"))), F.lit(0)).cast("bigint").alias(name)
              for kind, name in enumerate(COUNTED)]
    sums = [F.sum(n).cast(money.get(n, "bigint")).alias(n) for n in SUMS[:-1]]
    sums.append(F.coalesce(F.sum("line_count"), F.lit(0)).cast("bigint").alias("line_count"))
    return united.groupBy(*keys).agg(*sums, *counts)
