"""Q-7 / K-12: failing rows of tests, kept in an append-only store.

A capture appends its rows, then a marker with the capture's id.  Readers take, for
each (invocation, test), the rows of the last marker only: capturing again
replaces what was there, also by nothing, other tests are not touched, and a
writer that dies before its marker has written nothing that anyone reads.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.operators.runlog import SEQ, WRITTEN, fold, writes

ROWS = "capture_id string, failure_record string"
MARKERS = ("invocation_id string, test_id string, capture_id string, captured_at timestamp_ntz, "
           f"{SEQ} struct<at:timestamp_ntz,id:string>, {WRITTEN} array<string>")


def as_records(failing: DataFrame) -> DataFrame:
    """Each row as a JSON object with all of its fields, nulls kept (F-27)."""
    return failing.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in failing.columns]),
                                    {"ignoreNullFields": "false"}).alias("failure_record"))


def capture(failing: DataFrame, invocation_id: str, test_id: str, captured_at: dt.datetime,
            store: str) -> str:
    """Append the failing rows of a test, which may be none; returns the capture's id."""
    spark, key = failing.sparkSession, uuid.uuid4().hex
    as_records(failing).select(F.lit(key).alias("capture_id"), "failure_record") \
        .write.mode("append").parquet(f"{store}/rows")
    spark.createDataFrame([(invocation_id, test_id, key, captured_at)],
                          "invocation_id string, test_id string, capture_id string, "
                          "captured_at timestamp_ntz") \
        .withColumn(SEQ, F.struct(F.col("captured_at").alias("at"), F.col("capture_id").alias("id"))) \
        .withColumn(WRITTEN, writes("capture_id", "captured_at")) \
        .write.mode("append").parquet(f"{store}/captures")
    return key


def captures(spark: SparkSession, store: str) -> DataFrame:
    """The last capture of each (invocation, test)."""
    return fold(spark.read.schema(MARKERS).parquet(f"{store}/captures"),
                ["invocation_id", "test_id"])


def evidence(spark: SparkSession, store: str) -> DataFrame:
    """``invocation_id``, ``test_id``, ``captured_at`` and ``failure_record`` of every
    row of the last captures."""
    rows = spark.read.schema(ROWS).parquet(f"{store}/rows")
    return rows.join(captures(spark, store), "capture_id").select(
        "invocation_id", "test_id", "captured_at", "failure_record")
