"""Q-FRESH: source freshness against the warn/error policy.

Per source: ``max(loaded_at field)`` (a one-row partial aggregate over one
column of the raw table), its age at ``checked_at`` and the status: ``error``
past the error threshold, ``warn`` past the warn threshold, else ``pass``.
The order sources are checked on their business timestamp with a warning
threshold only; the rest on ``_loaded_at`` with both.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.unions import union_all

# The freshness policy of the reference's source declarations.
WARN_AFTER_HOURS = 25
ERROR_AFTER_HOURS = 48
SOURCES = [
    # table, loaded-at field, warn hours, error hours, freshness type
    ("salesorderheader", "modifieddate", WARN_AFTER_HOURS, None, "business"),
    ("salesorderdetail", "modifieddate", WARN_AFTER_HOURS, None, "business"),
    ("customer", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("salesterritory", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("product", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("person", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("store", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("specialoffer", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("salesperson", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
    ("employee", "_loaded_at", WARN_AFTER_HOURS, ERROR_AFTER_HOURS, "technical"),
]
SOURCE_NAME = "raw"
PROJECT = "sales_star"
DEFAULT_CHECKED_AT = "2001-08-03 12:00:00"


def source_freshness(raw: dict[str, DataFrame], checked_at: str = DEFAULT_CHECKED_AT
                     ) -> DataFrame:
    parts = []
    for table, field, warn_h, error_h, kind in SOURCES:
        parts.append(raw[table].agg(F.max(field).alias("max_loaded_at")).select(
            F.lit(f"source.{PROJECT}.{SOURCE_NAME}.{table}").alias("source_unique_id"),
            F.lit(SOURCE_NAME).alias("source_name"),
            F.lit(table).alias("table_name"),
            F.lit(kind).alias("freshness_type"),
            F.lit(field).alias("loaded_at_field"),
            F.col("max_loaded_at").cast("timestamp_ntz").alias("max_loaded_at"),
            F.lit(warn_h).cast("int").alias("warn_after_hours"),
            F.lit(error_h).cast("int").alias("error_after_hours"),
        ))
    sources = union_all(parts)
    snap = F.expr(f"timestamp_ntz'{checked_at}'")
    age = F.expr(f"timestampdiff(SECOND, max_loaded_at, timestamp_ntz'{checked_at}')")
    return sources.select(
        "*",
        snap.alias("snapshotted_at"),
        age.cast("bigint").alias("age_seconds"),
    ).withColumn(
        "status",
        F.when(F.col("error_after_hours").isNotNull()
               & (F.col("age_seconds") > F.col("error_after_hours") * 3600), "error")
        .when(F.col("age_seconds") > F.col("warn_after_hours") * 3600, "warn")
        .otherwise("pass"),
    )


def oracle_sql() -> str:
    from starwright import oracle as O

    parts = []
    for table, field, warn_h, error_h, kind in SOURCES:
        col = "modified_at" if field == "modifieddate" else "_loaded_at"
        err = "CAST(NULL AS INTEGER)" if error_h is None else f"CAST({error_h} AS INTEGER)"
        parts.append(
            f"SELECT 'source.{PROJECT}.{SOURCE_NAME}.{table}' AS source_unique_id, "
            f"'{SOURCE_NAME}' AS source_name, '{table}' AS table_name, "
            f"'{kind}' AS freshness_type, '{field}' AS loaded_at_field, "
            f"max({col}) AS max_loaded_at, CAST({warn_h} AS INTEGER) AS warn_after_hours, "
            f"{err} AS error_after_hours FROM stg_{table}"
        )
    body = "\nUNION ALL\n".join(parts)
    ts = f"TIMESTAMP '{DEFAULT_CHECKED_AT}'"
    select = f"""
SELECT *, CASE WHEN error_after_hours IS NOT NULL AND age_seconds > error_after_hours * 3600
               THEN 'error'
               WHEN age_seconds > warn_after_hours * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT *, {ts} AS snapshotted_at,
             CAST(date_diff('second', max_loaded_at, {ts}) AS BIGINT) AS age_seconds
      FROM ({body}) s) x"""
    O.cte("src_freshness", [f"stg_{t}" for t, *_ in SOURCES], select)
    return O.sql("SELECT * FROM src_freshness", "src_freshness")
