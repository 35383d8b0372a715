"""Global ranking without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
For ranks over an unbounded set of members (customers, sales people) the rank
is computed in a distributed way instead:

* ``global_dense_rank``: the distinct values are range-partitioned (sampled
  split points, descending) and sorted within each partition; each partition
  numbers its values locally and a per-partition count table — one row per
  partition, so its size is bounded by the partition count, not the data —
  gives each partition's offset.
* ``top_n_with_ties``: ``TOPN(n, …)`` keeps the rows whose value is at least
  the n-th largest.  The threshold comes from ``orderBy(...).limit(n)``
  (TakeOrderedAndProject: every task keeps only its n best rows), so no
  global sort is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.session import checkpoint_dir


def global_dense_rank(df: DataFrame, value: str, out: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Dense rank of ``value`` descending (1 = largest) attached to every row;
    rows with a null ``value`` get a null rank.

    The distinct values are range-partitioned descending and sorted inside
    each partition; ``monotonically_increasing_id`` then numbers them in that
    order (partition id in the upper bits, position in the lower 33), so the
    local position needs no further shuffle.  Partition sizes (one row per
    partition) give each partition's offset."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(F.col(value).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    # Range bounds come from sampling and the ids from row positions, so a
    # recomputation could number differently: checkpoint once (shared folder)
    # and let the size table and the positions read the same rows.
    checkpoint_dir(spark)
    ranged = (
        values.repartitionByRange(n, F.col("__v").desc())
        .sortWithinPartitions(F.col("__v").desc())
        .select("__v", F.monotonically_increasing_id().alias("__id"))
        .select("__v", (F.col("__id") / (1 << 33)).cast("bigint").alias("__pid"),
                (F.col("__id") % (1 << 33) + 1).alias("__local"))
        .checkpoint()
    )
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # bounded by the partition count: one row per range partition
    offsets = sizes.select(
        "__pid",
        F.coalesce(F.sum("__n").over(
            Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("__off"),
    )
    ranks = ranged.join(F.broadcast(offsets), "__pid").select(
        "__v", (F.col("__off") + F.col("__local")).cast("int").alias(out))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__v")), "left").drop("__v")


def top_n_threshold(df: DataFrame, value: str, n: int) -> DataFrame:
    """One-row DataFrame with the n-th largest non-null ``value`` (ties count as rows)."""
    best = df.where(F.col(value).isNotNull()).select(value).orderBy(F.col(value).desc()).limit(n)
    return best.agg(F.min(value).alias("__threshold"))


def top_n_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose ``value`` is among the n largest, ties at the boundary kept."""
    t = top_n_threshold(df, value, n)
    return df.crossJoin(F.broadcast(t)).where(F.col(value) >= F.col("__threshold")) \
        .drop("__threshold")
