"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the whole
driver tables.  Modules register themselves on import (see ``load_all``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    # importing the query modules fills the registry
    from starwright.queries import (  # noqa: F401
        measures_q, observability_q, quality_q, star_q,
    )
