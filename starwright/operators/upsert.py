"""B-1: keyed upsert with a partial column list, and versioned table swaps.

``upsert(target, updates, keys, columns)`` is ``INSERT … ON CONFLICT (keys) DO
UPDATE SET <columns> = excluded.<columns>`` as one full-outer join on the keys:

* new keys are inserted (columns absent from ``updates`` are null);
* existing keys take the update's value for every listed column — even a null,
  like ``excluded.col`` — and keep the old value for every other column;
* several updates of one key in a batch: the last by ``order_by`` wins.

Parquet files are immutable, so a table "upsert" writes the merged result to
a new version folder and then moves the table's ``_current`` pointer; readers
never see a half-written version and the old one stays readable until then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, keys: list[str],
           columns: list[str] | None = None, order_by: str | None = None) -> DataFrame:
    update_cols = [c for c in updates.columns if c not in keys]
    listed = update_cols if columns is None else list(columns)
    if order_by is not None:
        w = Window.partitionBy(*keys).orderBy(F.col(order_by).desc())
        updates = updates.withColumn("__rn", F.row_number().over(w)).where("__rn = 1") \
            .drop("__rn")
    t = target.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in target.columns
                               if c not in keys], F.lit(True).alias("__in_t"))
    u = updates.select(*keys, *[F.col(c).alias(f"__u_{c}") for c in update_cols],
                       F.lit(True).alias("__in_u"))
    j = t.join(u, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        old = F.col(f"__t_{c}")
        if c in update_cols:
            new = F.col(f"__u_{c}")
            if c in listed:
                value = F.when(F.col("__in_u").isNotNull(), new).otherwise(old)
            else:  # not in the SET list: inserts take it, conflicts keep the old value
                value = F.when(F.col("__in_t").isNotNull(), old).otherwise(new)
        else:
            value = old
        out.append(value.alias(c))
    extra = [F.col(f"__u_{c}").alias(c) for c in update_cols if c not in target.columns]
    return j.select(*out, *extra)


# ------------------------------------------------------------ table storage
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _pointer_name(number: int) -> str:
    return f"_current.{number:012d}"


def _pointer_number(fs, folder) -> int | None:
    """The highest published pointer; pointers only grow and the last one is
    never deleted, so a table without one was never published."""
    if not fs.exists(folder):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return max((int(n[len("_current."):]) for n in names
                if n.startswith("_current.") and n[len("_current."):].isdigit()), default=None)


def current_version(spark: SparkSession, table_path: str) -> str | None:
    fs, folder, jvm = _fs(spark, table_path)
    number = _pointer_number(fs, folder)
    if number is None:
        return None
    pointer = jvm.org.apache.hadoop.fs.Path(f"{table_path}/{_pointer_name(number)}")
    stream = fs.open(pointer)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream))
        return reader.readLine().strip()
    finally:
        stream.close()


def read_table(spark: SparkSession, table_path: str, schema=None) -> DataFrame:
    """Current version of a versioned table; an absent table reads as empty
    with ``schema`` (S-16)."""
    version = current_version(spark, table_path)
    if version is None:
        if schema is None:
            raise FileNotFoundError(table_path)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{table_path}/{version}")


def write_version(df: DataFrame, table_path: str) -> str:
    """Write ``df`` as a new version, then publish it by a pointer of the next
    number: one rename, with nothing deleted, so a writer that dies at any point
    leaves the table as it was."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{table_path}/{version}")
    fs, _, jvm = _fs(spark, table_path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{table_path}/_current.{version}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    number = _pointer_number(fs, jvm.org.apache.hadoop.fs.Path(table_path))
    dst = jvm.org.apache.hadoop.fs.Path(f"{table_path}/{_pointer_name((number or 0) + 1)}")
    if not fs.rename(tmp, dst):
        raise RuntimeError(f"another writer published {dst.toString()} meanwhile")
    return version


def upsert_table(spark: SparkSession, table_path: str, updates: DataFrame, keys: list[str],
                 columns: list[str] | None = None, schema=None) -> str:
    """Merge ``updates`` into the table at ``table_path`` and publish a new version."""
    target = read_table(spark, table_path, schema or updates.schema)
    merged = upsert(target, updates, keys, columns)
    return write_version(merged, table_path)
