"""Column helpers: status rules, lenient ints, layers, calendar edge dates, truncation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starwright.functions import columns as C
from starwright.plans.calendar import calendar_columns
from starwright.plans.telemetry import aggregate_status, aggregate_status_value


def one(spark, expr, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


# -- status rules (the reference's domain unit cases)
def agg_status(spark, statuses, evidence=True):
    rows = [(s,) for s in statuses] if evidence else [(None,)]
    df = spark.createDataFrame(rows, "status string")
    return df.agg(*aggregate_status(F.col("status"))).select(
        aggregate_status_value().alias("s")).first()["s"]


def test_failure_has_precedence(spark):
    assert agg_status(spark, ["success", "failed"]) == "failed"


def test_warning_does_not_become_success(spark):
    assert agg_status(spark, ["success", "warn"]) == "warning"


def test_missing_evidence_is_not_healthy(spark):
    assert agg_status(spark, [], evidence=False) == "not_started"


def test_partial_evidence_requires_attention(spark):
    assert agg_status(spark, ["success", "success", "not_started"]) == "warning"


def test_only_not_applicable_is_not_started(spark):
    assert agg_status(spark, ["skipped", "skipped"]) == "not_started"


@pytest.mark.parametrize("raw,state", [
    ("skipped", "not_applicable"), ("PASS", "success"), ("runtime error", "failed"),
    ("started", "running"), ("blocked", "blocked"), ("not_monitored", "unmonitored"),
    (None, "not_started"), ("whatever", "not_started"), ("warn", "warning"),
])
def test_normalize_status(spark, raw, state):
    assert one(spark, C.normalize_status("v"), raw) == state


@pytest.mark.parametrize("run_id,kind", [
    ("manual__2026-08-14T12:00:00+00:00", "manual"),
    ("scheduled__2026-08-14T12:00:00+00:00", "scheduled"),
    ("backfill__2026-08-14", "scheduled"), ("other-id", "other"), (None, None), ("", None),
])
def test_trigger_type(spark, run_id, kind):
    assert one(spark, C.trigger_type("v"), run_id) == kind


# -- lenient integer conversion of failure counts
@pytest.mark.parametrize("raw,expected", [("3", 3), ("0", 0), (None, None), ("true", None),
                                          ("invalid", None)])
def test_lenient_int(spark, raw, expected):
    assert one(spark, C.try_int("v"), raw) == expected


@pytest.mark.parametrize("path,layer", [
    ("models/staging/stg_x.sql", "staging"), ("models\\analytics\\fact.sql", "analytics"),
    ("models/intermediate/int.sql", "intermediate"), ("seeds/x.csv", None), (None, None),
])
def test_layer_of(spark, path, layer):
    assert one(spark, C.layer_of("v"), path) == layer


def test_last_dotted(spark):
    assert one(spark, C.last_dotted("v"), "sales.customer") == "customer"


def test_varchar_truncates_like_the_warehouse(spark):
    assert one(spark, C.varchar("v", 3), "abcdef") == "abc"
    assert one(spark, C.varchar("v", 3), None) is None


def test_iso_calendar_edges(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2021, 1, 3),)], "full_date date")
    rows = {r["full_date"]: r for r in df.select(*calendar_columns(F.col("full_date"))).collect()}
    r = rows[dt.date(2024, 12, 31)]
    assert (r.iso_week_number, r.iso_week_year, r.year_iso_week) == (1, 2025, "2025-W01")
    assert (r.day_of_week_number, r.day_of_week_name, r.is_weekend) == (2, "Terça-feira", False)
    assert r.date_id == 20241231 and r.semester_number == 2 and r.year_quarter == "2024-Q4"
    r = rows[dt.date(2021, 1, 3)]
    assert (r.iso_week_number, r.iso_week_year, r.year_iso_week) == (53, 2020, "2020-W53")
    assert (r.day_of_week_number, r.is_weekend, r.month_name) == (7, True, "Janeiro")


def test_ratio_and_blank_arithmetic(spark):
    df = spark.createDataFrame([(None, None), (5, None), (None, 0)], "a int, b int")
    rows = df.select(C.blank_diff("a", "b").alias("d"), C.ratio("a", "b").alias("r")).collect()
    assert [r.d for r in rows] == [None, 5, 0]
    assert [r.r for r in rows] == [None, None, None]


def test_optional_parameter_predicate(spark):
    from starwright.plans.reports import optional_eq
    df = spark.createDataFrame([("a",), ("b",)], "run_id string")
    assert df.where(optional_eq("run_id", None)).count() == 2
    assert df.where(optional_eq("run_id", "a")).count() == 1
