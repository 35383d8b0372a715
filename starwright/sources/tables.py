"""Readers for the driver's parquet tables.

Every reader selects the columns it needs right away so Catalyst prunes the
Parquet scan (``ReadSchema``) and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


class Tables:
    """Lazy accessor ``Tables(spark, sf_dir).orders(...)`` with column pruning.

    Each table's relation is resolved once (file listing and footer schema)
    and reused; every call projects only the requested columns."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._relations: dict[str, DataFrame] = {}

    def relation(self, name: str) -> DataFrame:
        if name not in self._relations:
            self._relations[name] = self.spark.read.parquet(table_path(self.sf_dir, name))
        return self._relations[name]

    def __getattr__(self, name: str):
        if name not in TABLES:
            raise AttributeError(name)
        return lambda *cols: self.relation(name).select(*cols) if cols else self.relation(name)
