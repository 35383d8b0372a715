"""Helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starwright.session import checkpoint_dir

# A word is a maximal run of characters other than ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/starwright-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, so
    what follows survives lost executors without repeating what came before."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What a worker process keeps from one task to the next, one thing at a time.
_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What this process keeps under ``key``, made if it keeps something else."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Frees what a task of another operator left in this process for the next one."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, schema: str | T.StructType,
                start: Callable[[], Callable[..., list]], keeps: bool = False) -> DataFrame:
    """``mapInArrow`` over column lists.  ``start()`` runs once per task and
    returns a function from the batch's columns (Python lists) to the result's
    columns, or to an iterator of such column lists.  Unless it ``keeps`` something
    for the next task (see :func:`kept`), what others kept goes first."""
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        step = start()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = step(*(c.to_pylist() for c in batch.columns))
            for columns in ([made] if isinstance(made, list) else made):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow)

    return df.mapInArrow(run, out)


def words(text: F.Column) -> F.Column:
    """The words of a text as an array; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def n_words(text: F.Column) -> F.Column:
    return F.size(words(text)).cast("long")


def fold_of(key: F.Column, folds: int) -> F.Column:
    """crc32 of the key's decimal text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds
