"""K-10: profiles of the tables of the latest manifest's analytics models (S-14).

The models come from the newest run's manifest and the columns from the tables
themselves, so a new column or model is profiled without being declared here.

Nulls and months are summed within the tasks, by the month of the first date or timestamp
column whose name contains ``month``.  Of a line only a 64-bit hash of its columns and nulls
is dealt out; rows whose hash occurs again are read once more and compared by a second hash
as well.  Rows that agree in 128 bits are taken as equal: at 10^12 rows the chance that two
others do is about 10^-15.  Unexpected
values are the failures that the latest invocation recorded for tests of accepted
values that depend on the table (A-14), nothing is evaluated again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, StructType, TimestampNTZType, TimestampType

from starwright.operators.unions import union_all
from starwright.session import checkpoint_dir

MASK_BITS = 62


def month_column(schema: StructType) -> str | None:
    for field in schema.fields:
        if "month" in field.name.lower() and isinstance(
                field.dataType, DateType | TimestampType | TimestampNTZType):
            return field.name
    return None


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _written(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/starwright-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row, ``__h`` and ``__g``.  A hash skips nulls, so words of a
    bit for each null column are hashed as well: bit ``i % MASK_BITS`` of word
    ``i // MASK_BITS`` is set where column i is null."""
    hashed = [F.to_json(_named(f.name)) if isinstance(f.dataType, MapType) else _named(f.name)
              for f in df.schema.fields]
    null = [_named(c).isNull().cast("long") for c in df.columns]
    masks = [sum((F.shiftleft(bit, i) for i, bit in enumerate(null[at:at + MASK_BITS])),
                 F.lit(0).cast("long")) for at in range(0, len(null), MASK_BITS)]
    return [F.xxhash64(*masks, *hashed).alias("__h"),
            F.xxhash64(F.lit(1), *masks, *hashed).alias("__g")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows there are beyond the first of the same contents."""
    h, g = row_hashes(df)
    again = _written(df.select(h).groupBy("__h").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("__h"))
    counts = (df.select(h, g).join(again, "__h", "left_semi").groupBy("__h", "__g")
              .agg(F.count(F.lit(1)).alias("n")))
    if again.isEmpty():     # no row is read again
        counts = counts.sparkSession.createDataFrame([], counts.schema)
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
                      .alias("duplicate_rows"))


def table_profile(model: str, df: DataFrame) -> DataFrame:
    cols, month = df.columns, month_column(df.schema)
    months = df.withColumn("__month", F.trunc(_named(month), "MM") if month
                           else F.lit(None).cast("date")).groupBy("__month").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(_named(c).isNull()).alias(f"__n_{i}") for i, c in enumerate(cols)))
    stats = months.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        *(F.coalesce(F.sum(f"__n_{i}"), F.lit(0)).alias(f"__n_{i}") for i in range(len(cols))),
        F.count("__month").cast("int").alias("months_actual"),
        F.min("__month").alias("__mmin"), F.max("__month").alias("__mmax")) \
        .crossJoin(F.broadcast(duplicate_rows(df)))                   # one row each
    null_cells = sum((F.col(f"__n_{i}") for i in range(len(cols))), F.lit(0)).cast("bigint")
    null_columns = sum((F.when(F.col(f"__n_{i}") > 0, 1).otherwise(0) for i in range(len(cols))),
                       F.lit(0)).cast("int")
    cells = F.col("rows") * len(cols)
    if month:
        expected = F.when(F.col("__mmin").isNull(), 0).otherwise(
            F.months_between("__mmax", "__mmin").cast("int") + 1).cast("int")
        actual = F.col("months_actual")
    else:
        expected = F.lit(None).cast("int")
        actual = F.lit(None).cast("int")
    return stats.select(
        F.lit(f"analytics.{model}").alias("table"),
        "rows",
        F.lit(len(cols)).alias("columns"),
        F.when(cells > 0, F.bround(null_cells.cast("double") / cells.cast("double") * 100, 2))
        .otherwise(F.lit(0.0)).alias("missing_values_pct"),
        "duplicate_rows",
        null_cells.alias("null_cells"),
        null_columns.alias("null_columns"),
        actual.alias("months_actual"),
        expected.alias("months_expected"),
        F.when(actual.isNotNull() & (actual < expected), "warning").otherwise("success")
        .alias("volume_anomaly"),
    )


def latest_models(run_nodes: DataFrame, dbt_runs: DataFrame, layer: str = "analytics"
                  ) -> list[str]:
    """The names of the layer's models in the manifest of the newest run that stored
    one; as few as a project's models."""
    newest = (run_nodes.select("orchestrator_run_id").distinct()
              .join(dbt_runs, "orchestrator_run_id")
              .agg(F.max_by("orchestrator_run_id", F.struct("collected_at", "invocation_id"))
                   .alias("orchestrator_run_id")))
    models = run_nodes.join(F.broadcast(newest), "orchestrator_run_id").where(    # one row
        (F.col("resource_type") == "model") & (F.col("layer") == layer))
    return sorted(r.node_name for r in models.select("node_name").distinct().collect())


def recorded_failures(tables: list[str], test_results: DataFrame, dbt_runs: DataFrame
                      ) -> DataFrame:
    """A-14: for each table the failures that the newest invocation recorded for
    accepted-values tests whose dependencies mention it (0 for none); one pass
    over that invocation's results, a sum for each table."""
    newest = dbt_runs.agg(F.max_by("invocation_id", F.struct("collected_at", "invocation_id"))
                          .alias("invocation_id"))
    results = test_results.join(F.broadcast(newest), "invocation_id").where(     # one row
        F.lower("test_name").contains("accepted_value")).withColumn(
        "mentions", F.lower(F.array_join("depends_on", ",")))
    sums = results.agg(*(F.coalesce(
        F.sum(F.when(F.col("mentions").contains(t), F.col("failures"))), F.lit(0)).cast("bigint")
        .alias(t) for t in tables))
    return sums.select(F.inline(F.array(*(F.struct(
        F.lit(f"analytics.{t}").alias("table"), F.col(t).alias("unexpected_values"))
        for t in tables))))


def final_table_profiles(model: Callable[[str], DataFrame], run_nodes: DataFrame,
                         test_results: DataFrame, dbt_runs: DataFrame) -> DataFrame:
    """``model(name)`` gives a model's table."""
    names = latest_models(run_nodes, dbt_runs)
    profiles = union_all([table_profile(name, model(name)) for name in names])
    return profiles.join(F.broadcast(                            # a row for each model
        recorded_failures(names, test_results, dbt_runs)), "table")
