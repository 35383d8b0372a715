"""Ingestion (S-1 … S-6, B-2 … B-4): source → Parquet snapshot → raw table.

* ``read_source`` is the partitioned JDBC scan of one source table (the
  column list comes from the source catalog, i.e. the JDBC schema);
* ``add_load_columns`` appends ``_loaded_at`` (one value per table load) and
  ``_source_table`` = ``schema.table``;
* ``write_snapshot`` writes Snappy Parquet under
  ``raw/<object table>/load_date=<d>/run_id=<run>/`` — the extra ``run_id``
  level keeps same-day reloads side by side; the row count comes from an
  ``Observation`` collected by the same write job, not a second scan;
* ``refresh_raw`` rebuilds the raw table from the snapshot just written (not
  from the source), as the reference does;
* ``load_sources`` runs the tables in order and stops at the first failure,
  returning the ingestion-run rows (success and failure) for the upsert.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starwright.functions.columns import varchar
from starwright.operators.upsert import write_version
from starwright.plans.telemetry import OBJECT_TABLE_NAMES, SOURCE_TABLES

ERROR_MESSAGE_LIMIT = 4000

INGESTION_RUN_SCHEMA = (
    "run_id string, source_table string, started_at timestamp_ntz, "
    "finished_at timestamp_ntz, source_row_count bigint, minio_object string, "
    "file_name string, file_size_bytes bigint, minio_uploaded_at timestamp_ntz, "
    "raw_loaded_at timestamp_ntz, raw_row_count bigint, duration_seconds double, "
    "status string, error_message string"
)


def object_table_name(table: str) -> str:
    return OBJECT_TABLE_NAMES.get(table, table)


def object_name(loaded_at: dt.datetime, table: str) -> str:
    """``raw/<object table>/load_date=<yyyy-mm-dd>/<object table>.parquet``."""
    obj = object_table_name(table)
    return f"raw/{obj}/load_date={loaded_at.date().isoformat()}/{obj}.parquet"


def read_source(spark: SparkSession, url: str, schema: str, table: str,
                properties: dict[str, str], partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None,
                num_partitions: int = 1) -> DataFrame:
    """Partitioned JDBC read of one source table (parallel range scans on the key)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"{schema}.{table}")
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def key_bounds(keys: DataFrame, column: str, ranges: int, accuracy: int = 10_000) -> list:
    """Fewer than ``ranges`` bounds that cut ``column`` into ranges of about equal
    numbers of rows, ascending and distinct, from a quantile sketch: one pass, a few
    thousand values a task.  Each is off its rank by at most 1 / ``accuracy`` of all
    rows.  A whole-number key that holds several ranges' rows (it comes up as several
    bounds) gets a range of its own; without keys that are not null there are none."""
    if ranges < 2:
        return []
    at = [i / ranges for i in range(1, ranges)]
    found = keys.agg(F.percentile_approx(column, at, accuracy).alias("bounds")).first().bounds or []
    hot = {b + 1 for a, b in zip(found, found[1:], strict=False) if a == b and int(b) == b}
    return sorted({*found, *hot})


def range_predicates(column: str, bounds: list) -> list[str]:
    """SQL conditions, one for each range, that every row meets exactly once: null
    keys go with the first range, a bound belongs to the range above it."""
    if not bounds:
        return ["1 = 1"]
    text = [str(b) for b in bounds]
    return ([f"{column} < {text[0]} OR {column} IS NULL"]
            + [f"{column} >= {a} AND {column} < {b}"
               for a, b in zip(text, text[1:], strict=False)]
            + [f"{column} >= {text[-1]}"])


def read_balanced(spark: SparkSession, url: str, schema: str, table: str,
                  properties: dict[str, str], column: str, ranges: int = 64) -> DataFrame:
    """The table read by ``ranges`` tasks of about equal numbers of rows, however its
    numeric key ``column`` is spread.  The keys are read first, by equal steps between
    their ends, for their quantiles."""
    ends = spark.read.jdbc(
        url, f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {schema}.{table}) ends",
        properties=properties).first()
    if ends.lo is None:
        return read_source(spark, url, schema, table, properties)
    keys = read_source(spark, url, schema, table, properties, column, int(ends.lo),
                       int(ends.hi) + 1, ranges).select(column)
    return spark.read.jdbc(url, f"{schema}.{table}", properties=properties,
                           predicates=range_predicates(column, key_bounds(keys, column, ranges)))


def add_load_columns(df: DataFrame, schema: str, table: str, loaded_at: dt.datetime) -> DataFrame:
    return df.select(
        "*",
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
        F.lit(f"{schema}.{table}").alias("_source_table"),
    )


def snapshot_path(base: str, table: str, loaded_at: dt.datetime, run_id: str) -> str:
    obj = object_table_name(table)
    return f"{base}/raw/{obj}/load_date={loaded_at.date().isoformat()}/run_id={run_id}"


def write_snapshot(df: DataFrame, base: str, table: str, loaded_at: dt.datetime, run_id: str
                   ) -> tuple[str, int]:
    """Write one table's snapshot; returns (path, row count)."""
    path = snapshot_path(base, table, loaded_at, run_id)
    obs = Observation(f"snapshot_{table}_{run_id}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("compression", "snappy").parquet(path))
    return path, int(obs.get["rows"])


def path_size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def refresh_raw(spark: SparkSession, snapshot: str, raw_path: str) -> int:
    """Full refresh of the raw table from the snapshot; returns its row count.

    The new contents are written as a new version and published by moving the
    table's pointer, so a failed or lost job never leaves the table empty."""
    obs = Observation(f"raw_{abs(hash(raw_path))}")
    write_version(spark.read.parquet(snapshot).observe(obs, F.count(F.lit(1)).alias("rows")),
                  raw_path)
    return int(obs.get["rows"])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load_table(spark: SparkSession, source: DataFrame, schema: str, table: str, base: str,
               run_id: str, loaded_at: dt.datetime) -> dict:
    """Snapshot + raw refresh of one table; returns the B-2 ingestion row."""
    started = _now()
    t0 = time.monotonic()
    snap, rows = write_snapshot(add_load_columns(source, schema, table, loaded_at), base,
                                table, loaded_at, run_id)
    uploaded = _now()
    raw_rows = refresh_raw(spark, snap, f"{base}/warehouse/raw/{table}")
    finished = _now()
    name = object_name(loaded_at, table)
    return dict(run_id=run_id, source_table=f"{schema}.{table}", started_at=started,
                finished_at=finished, source_row_count=rows, minio_object=name,
                file_name=name.rsplit("/", 1)[-1], file_size_bytes=path_size(spark, snap),
                minio_uploaded_at=uploaded, raw_loaded_at=finished, raw_row_count=raw_rows,
                duration_seconds=time.monotonic() - t0, status="success", error_message=None)


def failure_row(run_id: str, schema: str, table: str, started: dt.datetime, error: Exception
                ) -> dict:
    """B-3: on conflict only finish time, duration, status and message change."""
    finished = _now()
    return dict(run_id=run_id, source_table=f"{schema}.{table}", started_at=started,
                finished_at=finished, duration_seconds=(finished - started).total_seconds(),
                status="failed", error_message=str(error)[:ERROR_MESSAGE_LIMIT])


FAILURE_COLUMNS = ["finished_at", "duration_seconds", "status", "error_message"]


def load_sources(spark: SparkSession, sources: dict[str, DataFrame], base: str, run_id: str,
                 loaded_at: dt.datetime, order=SOURCE_TABLES) -> tuple[list[dict], Exception | None]:
    """Load the sources in order; stop at the first failure (S-6).

    Returns the ingestion rows written so far (the failed table's row last)
    and the error, if any.  The loop runs over the ten source tables — a
    bounded driver loop; every table load is a distributed job.
    """
    rows: list[dict] = []
    for schema, table in order:
        if table not in sources:
            continue
        started = _now()
        try:
            rows.append(load_table(spark, sources[table], schema, table, base, run_id, loaded_at))
        except Exception as exc:  # record and abort the run
            rows.append(failure_row(run_id, schema, table, started, exc))
            return rows, exc
    return rows, None


def ingestion_rows_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    cols = [c.split(" ")[0] for c in INGESTION_RUN_SCHEMA.split(", ")]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    df = spark.createDataFrame(data, INGESTION_RUN_SCHEMA)
    return df.withColumn("error_message", varchar("error_message", ERROR_MESSAGE_LIMIT))


# ------------------------------------------------------- B-4 / B-5 run rows
DEFAULT_SLA_MINUTES = 1440
PIPELINE_RUN_SCHEMA = ("run_id string, started_at timestamp_ntz, finished_at timestamp_ntz, "
                       "duration_seconds double, status string, error_message string")


def dataset_freshness_rows(ingestion: DataFrame, sla_minutes: int = DEFAULT_SLA_MINUTES
                           ) -> DataFrame:
    """B-4: one freshness row per successfully loaded dataset of a run."""
    return ingestion.where(F.col("status") == "success").select(
        "run_id",
        F.col("source_table").alias("dataset_name"),
        F.col("started_at").alias("source_updated_at"),
        F.col("minio_uploaded_at").alias("minio_updated_at"),
        F.col("finished_at").alias("warehouse_updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("analytics_updated_at"),
        F.lit(sla_minutes).alias("sla_minutes"),
        F.lit("success").alias("status"),
    )


def pipeline_run_row(spark: SparkSession, run_id: str, status: str,
                     started_at: dt.datetime | None = None,
                     finished_at: dt.datetime | None = None,
                     error_message: str | None = None) -> DataFrame:
    """B-5: one lifecycle event of a pipeline run (start, success or failure)."""
    duration = ((finished_at - started_at).total_seconds()
                if started_at is not None and finished_at is not None else None)
    return spark.createDataFrame(
        [(run_id, started_at, finished_at, duration, status,
          None if error_message is None else error_message[:ERROR_MESSAGE_LIMIT])],
        PIPELINE_RUN_SCHEMA)


def mark_analytics_updated(freshness: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    """B-5 on success: set ``analytics_updated_at`` of every dataset of the run
    (an update by predicate, expressed as a projection)."""
    return freshness.withColumn(
        "analytics_updated_at",
        F.when(F.col("run_id") == run_id, F.lit(at).cast("timestamp_ntz"))
        .otherwise(F.col("analytics_updated_at")))


# The numeric key of each source table.
SOURCE_KEYS = {
    "salesorderheader": "salesorderid", "salesorderdetail": "salesorderdetailid",
    "customer": "customerid", "salesterritory": "territoryid", "store": "businessentityid",
    "specialoffer": "specialofferid", "salesperson": "businessentityid",
    "product": "productid", "person": "businessentityid", "employee": "businessentityid",
}


def jdbc_sources(spark: SparkSession, url: str, properties: dict[str, str],
                 partitioning: dict[str, tuple[str, int, int, int]] | None = None,
                 ranges: int = 64) -> dict[str, DataFrame]:
    """The ten source tables as JDBC reads of ``ranges`` balanced key ranges; the rows
    are fetched when a snapshot is written.  ``partitioning`` maps a table to ``(key
    column, lower bound, upper bound, partitions)`` to be read by equal steps."""
    out = {}
    for schema, table in SOURCE_TABLES:
        given = (partitioning or {}).get(table)
        out[table] = (read_source(spark, url, schema, table, properties, *given) if given else
                      read_balanced(spark, url, schema, table, properties, SOURCE_KEYS[table],
                                    ranges))
    return out
