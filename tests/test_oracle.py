"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from starwright import registry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
registry.load_all()
OPTIONAL = "starwright.llm"           # has its own tests
QUERIES = {name: fn for name, fn in E.queries().items()
           if name in registry.QUERIES
           and not registry.QUERIES[name].__module__.startswith(OPTIONAL)}
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r
    assert "strict_type_diffs" not in r, r     # identical types, decimal precision included


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "sales_month" in df.columns


def test_every_query_has_oracle_or_is_listed():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == sorted(ROWS_ONLY), missing


ROWS_ONLY: set[str] = set()
