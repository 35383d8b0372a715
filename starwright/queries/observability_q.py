"""Observability queries (telemetry from ``events``, lineage, profiles)."""

from __future__ import annotations

import datetime as dt

import uuid

from pyspark.sql import functions as F

from starwright import oracle as O
from starwright.operators import constraints, evidence
from starwright.operators.contracts import CONTRACTS, declared_columns
from starwright.operators.unions import union_all
from starwright.plans import profile, reports
from starwright.plans.rules import singular_failures
from starwright.plans.telemetry import (
    ACCEPTED_MODELS, EVENT_STATUS, MODEL_NODES, SOURCE_TABLES, TEST_KINDS, OBJECT_TABLE_NAMES, Telemetry,
    MODEL_DEPS, TRIAL_DEPS, manifest_rows,
)
from starwright.plans.warehouse import MODEL_LAYERS, Warehouse
from starwright.queries.quality_q import _SINGULAR_SQL as SINGULAR_SQL
from starwright.registry import register
from starwright.session import checkpoint_dir

CHECKED_AT = dt.datetime(2024, 1, 31, 12, 0, 0)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_STATUS_CASE = "CASE event_type " + " ".join(
    f"WHEN '{raw}' THEN '{word}'" for raw, word in EVENT_STATUS) + " ELSE 'not_started' END"
_IDX = "(user_id % 10) + 1"
_TABLES = _list([t for _, t in SOURCE_TABLES])
_SCHEMAS = _list([s for s, _ in SOURCE_TABLES])

O.cte("tm_events", [], f"""
SELECT event_id, ts, value, props,
       CASE WHEN day(ts) % 7 = 0 THEN 'manual__' ELSE 'scheduled__' END
         || strftime(ts, '%Y-%m-%d') AS run_id,
       'inv-' || strftime(ts, '%Y%m%d') AS invocation_id,
       {_SCHEMAS}[{_IDX}] || '.' || {_TABLES}[{_IDX}] AS source_table,
       {_TABLES}[{_IDX}] AS table_name,
       {_STATUS_CASE} AS status,
       {_list(TEST_KINDS)}[((user_id // 10) % 4) + 1] || '_stg_' || {_TABLES}[{_IDX}]
         || '_c' || CAST((user_id // 10) % 5 AS VARCHAR) AS test_name,
       {_list(MODEL_NODES)}[(event_id % {len(MODEL_NODES)}) + 1] AS model_name
FROM events""")

_ORDERS = ", ".join(f"'{t}'" for _, t in SOURCE_TABLES[:2])

O.cte("tm_owners", [], f"""
SELECT {_TABLES}[i + 1] AS table_name, {_SCHEMAS}[i + 1] AS owner_group, s_name AS owner_name,
       lower(replace(s_name, '#', '.')) || '@example.com' AS owner_email
FROM (SELECT s_suppkey % 10 AS i, s_name,
             row_number() OVER (PARTITION BY s_suppkey % 10
                                ORDER BY s_acctbal DESC, s_suppkey DESC) AS k
      FROM supplier) x WHERE k = 1""")

# the last write of a key is its row: every event writes all columns of its result
O.cte("tm_tests", ["tm_events", "tm_owners"], """
SELECT invocation_id, run_id AS orchestrator_run_id,
       'test.sales_star.' || test_name AS test_unique_id, test_name,
       'generic' AS test_type,
       CASE WHEN status = 'warn' THEN 'warn' ELSE 'error' END AS severity,
       status,
       CASE WHEN status IN ('failed', 'warn') THEN CAST(floor(value) AS BIGINT)
            ELSE CAST(0 AS BIGINT) END AS failures,
       value AS execution_seconds,
       CASE WHEN status IN ('failed', 'warn')
            THEN 'Got ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' results' END
         AS message,
       CASE WHEN starts_with(test_name, 'accepted_values')
            THEN ['model.sales_star.stg_' || table_name,
                  'model.sales_star.' || CASE table_name """ + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in ACCEPTED_MODELS.items()) + """ END]
            ELSE ['model.sales_star.stg_' || table_name] END AS depends_on,
       ts AS collected_at, owner_group, owner_name, owner_email
FROM (SELECT * FROM tm_events QUALIFY row_number() OVER (
        PARTITION BY invocation_id, test_name ORDER BY ts DESC, event_id DESC) = 1) e
LEFT JOIN tm_owners USING (table_name)""")

O.cte("tm_nodes", ["tm_events"], """
SELECT invocation_id, run_id AS orchestrator_run_id,
       'model.sales_star.' || model_name AS node_unique_id, status
FROM tm_events QUALIFY row_number() OVER (
  PARTITION BY invocation_id, model_name ORDER BY ts DESC, event_id DESC) = 1""")

O.cte("tm_checks", ["tm_events"], f"""
SELECT invocation_id, run_id AS orchestrator_run_id, table_name,
       CASE WHEN table_name IN ({_ORDERS}) THEN 'business' ELSE 'technical' END AS freshness_type,
       CASE status WHEN 'failed' THEN 'error' WHEN 'warn' THEN 'warn' ELSE 'pass' END AS status,
       ts AS max_loaded_at, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS snapshotted_at,
       value AS age_seconds, ts AS collected_at
FROM tm_events QUALIFY row_number() OVER (
  PARTITION BY invocation_id, table_name ORDER BY ts DESC, event_id DESC) = 1""")

O.cte("tm_runs", ["tm_tests"], """
SELECT invocation_id, orchestrator_run_id,
       min(collected_at) AS generated_at, max(collected_at) AS collected_at,
       CASE WHEN bool_or(lower(status) IN ('error', 'fail', 'failed', 'runtime error'))
            THEN 'error'
            WHEN bool_or(lower(status) IN ('warn', 'warning')) THEN 'warn'
            ELSE 'success' END AS status,
       CAST(sum(CAST(execution_seconds AS DECIMAL(18,3))) AS DECIMAL(38,3)) AS elapsed_seconds,
       CAST(count(*) AS BIGINT) AS test_nodes,
       CAST(count(*) FILTER (WHERE lower(status) IN ('error', 'fail', 'failed', 'runtime error'))
            AS BIGINT) AS failed_tests
FROM tm_tests GROUP BY 1, 2""")

_OBJ = "CASE table_name " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in OBJECT_TABLE_NAMES.items()) + " ELSE table_name END"

# an attempt that fails writes only how it ended; the rest is the last success's
O.cte("tm_ingestion", ["tm_events"], f"""
SELECT run_id, source_table, ok.row_count AS source_row_count, ok.row_count AS raw_row_count,
       ok.minio_object AS minio_object, ok.file_size_bytes AS file_size_bytes,
       COALESCE(ok.started_at, first_at) AS started_at,
       ok.finished_at AS minio_uploaded_at, ok.finished_at AS raw_loaded_at,
       ended.finished_at AS finished_at, ended.duration_seconds AS duration_seconds,
       CASE WHEN ended.failed THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN ended.failed THEN 'load failed: ' || source_table END AS error_message
FROM (SELECT run_id, source_table,
             arg_max(struct_pack(finished_at := finished_at, failed := status = 'failed',
               duration_seconds := CAST(CAST(value AS DECIMAL(18,3)) AS DECIMAL(38,3))),
               (ts, event_id)) AS ended,
             arg_max(struct_pack(row_count := CAST(event_id % 1000 + 1 AS BIGINT),
               started_at := ts, finished_at := finished_at,
               file_size_bytes := CAST(length(props) AS BIGINT),
               minio_object := 'raw/' || obj || '/load_date=' || strftime(ts, '%Y-%m-%d') || '/'
                               || obj || '.parquet'),
               (ts, event_id)) FILTER (WHERE status <> 'failed') AS ok,
             min(ts) AS first_at
      FROM (SELECT *, {_OBJ} AS obj, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS finished_at
            FROM tm_events) e
      GROUP BY run_id, source_table) g""")

_PIPELINE = """
SELECT run_id, first_at AS started_at, l.finished_at AS finished_at,
       l.duration_seconds AS duration_seconds, l.status AS status,
       CASE WHEN l.status = 'failed' THEN 'pipeline failed' END AS error_message
FROM (SELECT run_id, min(ts) AS first_at,
             arg_max(struct_pack(status := status,
               finished_at := CASE WHEN status <> 'running'
                              THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END,
               duration_seconds := CASE WHEN status <> 'running'
                                   THEN CAST(floor(value) AS BIGINT) END),
               (ts, event_id)) AS l
      FROM ({log}) e GROUP BY run_id) g"""
_PIPELINE_LOG = "SELECT * FROM tm_events WHERE status IN ('running', 'success', 'failed')"
O.cte("tm_pipeline", ["tm_events"], _PIPELINE.format(log=_PIPELINE_LOG))
# the newest run has not ended: its only entries are starts
O.cte("tm_pipeline_unfinished", ["tm_events"], _PIPELINE.format(log=f"""
  SELECT ts, event_id, value, run_id,
         CASE WHEN run_id = (SELECT arg_max(run_id, (ts, event_id)) FROM ({_PIPELINE_LOG}) z)
              THEN 'running' ELSE status END AS status
  FROM ({_PIPELINE_LOG}) x"""))
O.cte("tm_pipeline_unrecorded", ["tm_pipeline"], "SELECT * FROM tm_pipeline WHERE false")

_TRIGGER = ("CASE WHEN run_id IS NULL OR run_id = '' THEN NULL "
            "WHEN starts_with(run_id, 'manual__') THEN 'manual' "
            "WHEN starts_with(run_id, 'scheduled__') OR starts_with(run_id, 'backfill__') "
            "THEN 'scheduled' ELSE 'other' END")

_NORM = ("CASE WHEN lower(COALESCE({s}, 'not_started')) IN ('success', 'pass', 'passed') "
         "THEN 'success' "
         "WHEN lower(COALESCE({s}, 'not_started')) IN ('warn', 'warning') THEN 'warning' "
         "WHEN lower(COALESCE({s}, 'not_started')) IN ('error', 'fail', 'failed', "
         "'runtime error') THEN 'failed' "
         "WHEN lower(COALESCE({s}, 'not_started')) IN ('running', 'started') THEN 'running' "
         "WHEN lower(COALESCE({s}, 'not_started')) = 'blocked' THEN 'blocked' "
         "WHEN lower(COALESCE({s}, 'not_started')) IN ('skipped', 'not_applicable') "
         "THEN 'not_applicable' "
         "WHEN lower(COALESCE({s}, 'not_started')) IN ('unmonitored', 'not_monitored') "
         "THEN 'unmonitored' ELSE 'not_started' END")


def _tm(spark, sf_dir) -> Telemetry:
    return Telemetry.for_session(spark, sf_dir)


@register("run_history", O.sql(f"""
SELECT p.run_id, p.started_at, p.finished_at, p.duration_seconds, p.status, p.error_message,
       CAST(COALESCE(c.dataset_count, 0) AS BIGINT) AS dataset_count,
       {_TRIGGER.replace('run_id', 'p.run_id')} AS trigger_type
FROM tm_pipeline p
LEFT JOIN (SELECT run_id, count(source_table) AS dataset_count FROM tm_ingestion GROUP BY 1) c
  USING (run_id)
ORDER BY p.started_at DESC LIMIT 20""", "tm_pipeline", "tm_ingestion"))
def run_history(spark, sf_dir):
    """K-3: the 20 newest runs with dataset count and trigger type."""
    return reports.run_history(_tm(spark, sf_dir), 20)


@register("ingestion_rollup", O.sql("""
SELECT run_id, max(finished_at) AS finished_at,
       CAST(sum(duration_seconds) AS DECIMAL(38,3)) AS duration_seconds,
       bool_and(status = 'success') AS successful,
       bool_and(source_row_count IS NOT NULL) AS source_complete,
       bool_and(minio_uploaded_at IS NOT NULL) AS minio_complete,
       bool_and(raw_loaded_at IS NOT NULL) AS raw_complete,
       CAST(count(*) AS BIGINT) AS datasets
FROM tm_ingestion GROUP BY run_id""", "tm_ingestion"))
def ingestion_rollup(spark, sf_dir):
    """A-7: per-run ingestion completeness (bool_and ×4, max, sum, count)."""
    return reports.ingestion_rollup(_tm(spark, sf_dir))


@register("dbt_run_rollup", O.sql("""
SELECT orchestrator_run_id, max(collected_at) AS collected_at,
       CASE WHEN bool_or(status IN ('error', 'failed')) THEN 'error'
            WHEN bool_or(status IN ('warn', 'warning')) THEN 'warn' ELSE 'success' END AS status,
       CAST(sum(elapsed_seconds) AS DECIMAL(38,3)) AS elapsed_seconds,
       CAST(sum(test_nodes) AS BIGINT) AS test_nodes,
       CAST(sum(failed_tests) AS BIGINT) AS failed_tests
FROM tm_runs GROUP BY orchestrator_run_id""", "tm_runs"))
def dbt_run_rollup(spark, sf_dir):
    """A-8 / A-16 / A-17: per orchestrated run status precedence and counts."""
    return reports.dbt_run_rollup(_tm(spark, sf_dir))


_LATEST_RUN = ("(SELECT orchestrator_run_id FROM tm_runs WHERE orchestrator_run_id IS NOT NULL "
               "ORDER BY collected_at DESC LIMIT 1)")


@register("run_tests_latest", O.sql(f"""
SELECT t.test_name, t.test_type, t.status, t.failures AS failed_records, t.execution_seconds,
       t.message AS error_message, t.depends_on, t.owner_name, t.owner_email
FROM tm_tests t JOIN tm_runs r USING (invocation_id)
WHERE r.orchestrator_run_id = {_LATEST_RUN}
ORDER BY t.status DESC, t.test_name""", "tm_tests", "tm_runs"))
def run_tests_latest(spark, sf_dir):
    """K-6 / J-15 / O-4: tests of the latest orchestrated run."""
    return reports.run_tests(_tm(spark, sf_dir))


@register("data_quality_summary", O.sql(f"""
SELECT COALESCE(l.generated_at, l.collected_at) AS last_run_at, l.orchestrator_run_id AS run_id,
       c.total, c.passed, c.warnings, c.failed
FROM (SELECT * FROM tm_runs WHERE orchestrator_run_id IS NOT NULL
      ORDER BY collected_at DESC LIMIT 1) l
CROSS JOIN (
  SELECT CAST(count(*) AS BIGINT) AS total,
         CAST(count(*) FILTER (WHERE {_NORM.format(s='status')} = 'success') AS BIGINT) AS passed,
         CAST(count(*) FILTER (WHERE {_NORM.format(s='status')} = 'warning') AS BIGINT)
           AS warnings,
         CAST(count(*) FILTER (WHERE {_NORM.format(s='status')} = 'failed') AS BIGINT) AS failed
  FROM tm_tests WHERE invocation_id IN (
    SELECT invocation_id FROM tm_runs WHERE orchestrator_run_id = {_LATEST_RUN})) c""",
                                       "tm_tests", "tm_runs"))
def data_quality_summary(spark, sf_dir):
    """K-11 / A-18 / J-12: pass / warning / fail counts of the latest run."""
    return reports.data_quality_summary(_tm(spark, sf_dir))


@register("latest_test_results", O.sql("""
SELECT dataset, invocation_id, test_unique_id, test_name, test_type, severity, status, failures,
       message, execution_seconds
FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY status DESC, test_name) AS k
  FROM (
    SELECT d.dataset, t.*, row_number() OVER (
             PARTITION BY d.dataset, t.test_unique_id
             ORDER BY r.collected_at DESC, t.collected_at DESC, t.invocation_id DESC) AS rn
    FROM tm_tests t JOIN tm_runs r USING (invocation_id)
    JOIN (SELECT DISTINCT split_part(source_table, '.', -1) AS dataset FROM tm_ingestion) d
      ON contains(lower(array_to_string(t.depends_on, '|')), d.dataset)
  ) x WHERE rn = 1
) y WHERE k <= 50""", "tm_tests", "tm_runs", "tm_ingestion"))
def latest_test_results(spark, sf_dir):
    """K-7 / W-1 / J-20: latest result per test for every dataset (≤ 50 each)."""
    return reports.latest_test_results(_tm(spark, sf_dir), 50)


@register("data_quality_results", O.sql(f"""
SELECT invocation_id, test_unique_id, test_name, test_type, severity, status,
       failures AS failed_records, execution_seconds, message, depends_on, owner_group,
       owner_name, owner_email
FROM tm_tests WHERE invocation_id IN (
  SELECT invocation_id FROM tm_runs WHERE orchestrator_run_id = {_LATEST_RUN})""",
                                       "tm_tests", "tm_runs"))
def data_quality_results(spark, sf_dir):
    """K-11 / J-12 / U-2: every test result of the latest run with its owner."""
    return reports.data_quality_results(_tm(spark, sf_dir))


@register("incidents", O.sql("""
SELECT * FROM (
  SELECT run_id, finished_at AS occurred_at, 'ingestion' AS origin,
         'Ingestion: ' || source_table AS test_name, 'error' AS severity, status,
         CAST(NULL AS BIGINT) AS invalid_records, error_message AS error,
         [source_table] AS depends_on,
         CAST(NULL AS VARCHAR) AS owner_name, CAST(NULL AS VARCHAR) AS owner_email
  FROM tm_ingestion WHERE status = 'failed'
  UNION ALL
  SELECT r.orchestrator_run_id, r.collected_at, 'dbt_test', t.test_name, t.severity, t.status,
         t.failures, t.message, t.depends_on, t.owner_name, t.owner_email
  FROM tm_tests t JOIN tm_runs r USING (invocation_id)
  WHERE lower(t.status) IN ('error', 'fail', 'failed', 'runtime error')
) u ORDER BY occurred_at DESC NULLS FIRST, origin, test_name, run_id LIMIT 100""",
                             "tm_ingestion", "tm_tests", "tm_runs"))
def incidents(spark, sf_dir):
    """K-13 / U-2: failed ingestions ∪ failed tests, newest 100."""
    return reports.incidents(_tm(spark, sf_dir), 100)


_CHECKED = f"TIMESTAMP '{CHECKED_AT:%Y-%m-%d %H:%M:%S}'"


@register("dataset_freshness_sla", O.sql(f"""
SELECT dataset, source_updated_at, minio_updated_at, warehouse_updated_at,
       analytics_updated_at, sla_minutes,
       CASE WHEN warehouse_updated_at IS NULL THEN 'failed'
            WHEN analytics_updated_at IS NULL THEN 'warning'
            WHEN ((epoch_us({_CHECKED}) - epoch_us(analytics_updated_at)) // 1000000) / 60
                 > sla_minutes THEN 'warning'
            ELSE stored_status END AS status
FROM (SELECT i.source_table AS dataset, i.started_at AS source_updated_at,
             i.minio_uploaded_at AS minio_updated_at, i.raw_loaded_at AS warehouse_updated_at,
             CASE WHEN p.status = 'success' THEN p.finished_at END AS analytics_updated_at,
             1440 AS sla_minutes, i.status AS stored_status
      FROM tm_ingestion i LEFT JOIN tm_pipeline p USING (run_id)
      WHERE i.run_id = (SELECT run_id FROM tm_pipeline ORDER BY started_at DESC LIMIT 1)) x""",
                                        "tm_ingestion", "tm_pipeline"))
def dataset_freshness_sla(spark, sf_dir):
    """B-4 / K-9: dataset freshness of the latest run against the SLA."""
    return reports.dataset_freshness(_tm(spark, sf_dir), CHECKED_AT)


# ------------------------------------------------------------------ lineage
def _manifest_values() -> str:
    rows = []
    for trial, graph in (("false", MODEL_DEPS), ("true", TRIAL_DEPS)):
        for nid, name, rtype, path, deps in manifest_rows(graph):
            rows.append(f"({trial}, '{nid}', '{name}', '{rtype}', '{path}', "
                        f"{_list(deps)}::VARCHAR[])")
    return "VALUES " + ", ".join(rows)


O.cte("lg_nodes", [], f"""
SELECT trial, node_unique_id, node_name, resource_type,
       CASE WHEN contains(replace(path, '\\', '/'), 'models/staging/') THEN 'staging'
            WHEN contains(replace(path, '\\', '/'), 'models/intermediate/') THEN 'intermediate'
            WHEN contains(replace(path, '\\', '/'), 'models/analytics/') THEN 'analytics'
       END AS layer,
       depends_on
FROM ({_manifest_values()}) v(trial, node_unique_id, node_name, resource_type, path, depends_on)""")
O.cte("lg_edges", ["lg_nodes"], """
SELECT trial, unnest(depends_on) AS parent, node_unique_id AS child FROM lg_nodes""")

_AGG = f"""
       count(status) AS n,
       bool_or(status IS NOT NULL AND {_NORM.format(s='status')} = 'failed') AS any_failed,
       bool_or(status IS NOT NULL AND {_NORM.format(s='status')} = 'running') AS any_running,
       bool_or(status IS NOT NULL AND {_NORM.format(s='status')} IN ('warning', 'blocked'))
         AS any_warning,
       count(*) FILTER (WHERE status IS NOT NULL
                        AND {_NORM.format(s='status')} <> 'not_applicable') AS applicable,
       count(*) FILTER (WHERE status IS NOT NULL
                        AND {_NORM.format(s='status')} IN ('not_started', 'unmonitored')) AS idle,
       count(*) FILTER (WHERE status IS NOT NULL
                        AND {_NORM.format(s='status')} = 'success') AS succeeded"""
_AGG_VALUE = """
CASE WHEN COALESCE(any_failed, false) THEN 'failed'
     WHEN COALESCE(any_running, false) THEN 'running'
     WHEN COALESCE(any_warning, false) THEN 'warning'
     WHEN n = 0 OR applicable = 0 OR applicable = idle THEN 'not_started'
     WHEN succeeded = applicable THEN 'success' ELSE 'warning' END"""


O.RECURSIVE.add("lg_reach")
O.cte("lg_reach", ["lg_nodes", "lg_edges"], """
SELECT trial, node_unique_id AS root, node_unique_id AS node
FROM lg_nodes WHERE resource_type = 'source'
UNION
SELECT r.trial, r.root, e.child
FROM lg_reach r JOIN lg_edges e ON e.trial = r.trial AND e.parent = r.node""")
O.cte("lg_applicable", ["lg_reach", "lg_nodes"], """
SELECT r.trial, s.node_name AS dataset, m.layer, m.node_unique_id AS node
FROM lg_reach r JOIN lg_nodes s ON s.trial = r.trial AND s.node_unique_id = r.root
JOIN lg_nodes m ON m.trial = r.trial AND m.node_unique_id = r.node
WHERE m.resource_type = 'model' AND m.layer IS NOT NULL""")
O.cte("lg_per_layer", ["tm_ingestion", "lg_applicable", "tm_nodes"], f"""
SELECT run_id, dataset, layer, {_AGG_VALUE} AS value
FROM (SELECT x.run_id, x.dataset, x.layer, {_AGG}
      FROM (SELECT r.run_id, r.dataset, a.layer, a.node, e.status
            FROM (SELECT run_id, split_part(source_table, '.', -1) AS dataset
                  FROM tm_ingestion) r
            JOIN lg_applicable a
              ON a.dataset = r.dataset AND a.trial = starts_with(r.run_id, 'manual__')
            LEFT JOIN (SELECT orchestrator_run_id AS run_id, node_unique_id AS node, status
                       FROM tm_nodes) e
              ON e.run_id = r.run_id AND e.node = a.node) x
      GROUP BY 1, 2, 3) g""")
O.cte("lg_stages", ["tm_ingestion", "lg_per_layer"], """
SELECT run_id, dataset, staging, intermediate, analytics,
       CASE WHEN analytics <> 'not_applicable' THEN 'unmonitored' ELSE 'not_applicable' END
         AS powerbi
FROM (
  SELECT run_id, dataset, st0 AS staging, st1 AS intermediate,
         CASE WHEN s2 = 'not_started'
                   AND (CASE WHEN st1 <> 'not_applicable' THEN st1
                             WHEN st0 <> 'not_applicable' THEN st0 ELSE 'success' END)
                       IN ('failed', 'blocked') THEN 'blocked' ELSE s2 END AS analytics
  FROM (SELECT *,
               CASE WHEN s1 = 'not_started'
                         AND (CASE WHEN st0 <> 'not_applicable' THEN st0 ELSE 'success' END)
                             IN ('failed', 'blocked') THEN 'blocked' ELSE s1 END AS st1
        FROM (SELECT *, s0 AS st0 FROM (
          SELECT r.run_id, r.dataset,
                 COALESCE(max(CASE WHEN p.layer = 'staging' THEN p.value END),
                          'not_applicable') AS s0,
                 COALESCE(max(CASE WHEN p.layer = 'intermediate' THEN p.value END),
                          'not_applicable') AS s1,
                 COALESCE(max(CASE WHEN p.layer = 'analytics' THEN p.value END),
                          'not_applicable') AS s2
          FROM (SELECT DISTINCT run_id, split_part(source_table, '.', -1) AS dataset
                FROM tm_ingestion) r
          LEFT JOIN lg_per_layer p ON p.run_id = r.run_id AND p.dataset = r.dataset
          GROUP BY 1, 2) w) a) b) st""")


@register("dataset_stage_status", O.sql("SELECT * FROM lg_stages", "lg_stages"))
def dataset_stage_status(spark, sf_dir):
    """L-1 / L-2 / L-3: per run and dataset, the status of each model layer
    downstream of the dataset's source (lineage closure, blocked propagation)."""
    return reports.dataset_stage_status(_tm(spark, sf_dir))


# ------------------------------------------------------------------ profiles
def _profile_sql(model: str) -> str:
    cols = [n for n, _ in declared_columns(model)]
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    null_cols = " + ".join(
        f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END" for c in cols)
    month = next((n for n, t in declared_columns(model)
                  if "month" in n and t in ("date", "timestamp", "timestamp_ntz")), None)
    if month:
        actual = f"CAST(count(DISTINCT date_trunc('month', {month})) AS INTEGER)"
        mn, mx = (f"date_trunc('month', min({month}))", f"date_trunc('month', max({month}))")
        expected = (f"CAST(CASE WHEN min({month}) IS NULL THEN 0 ELSE "
                    f"(year({mx}) - year({mn})) * 12 + month({mx}) - month({mn}) + 1 END "
                    f"AS INTEGER)")
    else:
        actual = expected = "CAST(NULL AS INTEGER)"
    n = len(cols)
    return f"""
SELECT 'analytics.{model}' AS "table", rows, {n} AS columns,
       CASE WHEN rows * {n} > 0 THEN round_even(CAST(null_cells AS DOUBLE) / (rows * {n}) * 100, 2)
            ELSE 0.0 END AS missing_values_pct,
       duplicate_rows, null_cells, null_columns, months_actual, months_expected,
       unexpected_values,
       CASE WHEN months_actual IS NOT NULL AND months_actual < months_expected THEN 'warning'
            ELSE 'success' END AS volume_anomaly
FROM (SELECT CAST(count(*) AS BIGINT) AS rows, CAST({nulls} AS BIGINT) AS null_cells,
             CAST({null_cols} AS INTEGER) AS null_columns,
             {actual} AS months_actual, {expected} AS months_expected,
             (SELECT CAST(COALESCE(sum(failures), 0) AS BIGINT) FROM tm_tests
              WHERE contains(lower(test_name), 'accepted_value')
                AND contains(lower(array_to_string(depends_on, ',')), '{model}')
                AND invocation_id = (SELECT invocation_id FROM tm_runs
                                     ORDER BY collected_at DESC, invocation_id DESC LIMIT 1))
               AS unexpected_values
      FROM {model}) s
CROSS JOIN (SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
            FROM (SELECT count(*) AS c FROM {model} GROUP BY ALL_COLS) d) d2""".replace(
        "GROUP BY ALL_COLS", "GROUP BY " + ", ".join(cols))


_PROFILED = MODEL_LAYERS["analytics"]


@register("final_table_profiles", O.sql(
    "\nUNION ALL\n".join(_profile_sql(m) for m in _PROFILED), *_PROFILED, "tm_tests", "tm_runs"))
def final_table_profiles(spark, sf_dir):
    """K-10 / S-14 / A-11 … A-14: profile of the latest manifest's analytics models."""
    wh, tm = Warehouse.from_driver(spark, sf_dir), _tm(spark, sf_dir)
    return profile.final_table_profiles(wh.model, tm.run_nodes, tm.test_results, tm.dbt_runs)


assert set(_PROFILED) <= set(CONTRACTS)


# ------------------------------------------------------- runs and datasets
O.cte("k_run_tests", ["tm_tests", "tm_runs"], """
SELECT t.* EXCLUDE (orchestrator_run_id), r.orchestrator_run_id AS run_id
FROM tm_tests t JOIN tm_runs r USING (invocation_id)""")

_ST = ["source", "minio", "raw", "staging", "intermediate", "analytics"]


def _in(word: str) -> str:
    return "(" + " OR ".join(f"{c} = '{word}'" for c in _ST) + ")"


def _cnt(cond: str) -> str:
    return "(" + " + ".join(f"CAST(COALESCE({cond.format(c=c)}, false) AS INTEGER)"
                            for c in _ST) + ")"


_TECH = f"""CASE WHEN {_in('failed')} THEN 'failed' WHEN {_in('running')} THEN 'running'
     WHEN {_in('warning')} OR {_in('blocked')} THEN 'warning'
     WHEN {_cnt("{c} <> 'not_applicable'")} = 0
       OR {_cnt("{c} <> 'not_applicable'")} = {_cnt("{c} IN ('not_started', 'unmonitored')")}
       THEN 'not_started'
     WHEN {_cnt("{c} = 'success'")} = {_cnt("{c} <> 'not_applicable'")} THEN 'success'
     ELSE 'warning' END"""

O.cte("k_ds_base", ["tm_ingestion", "lg_stages"], f"""
SELECT i.*, split_part(i.source_table, '.', -1) AS dataset_name,
       {_NORM.format(s='i.status')} AS source,
       CASE WHEN i.minio_uploaded_at IS NOT NULL THEN {_NORM.format(s='i.status')}
            ELSE 'not_started' END AS minio,
       CASE WHEN i.raw_loaded_at IS NOT NULL THEN {_NORM.format(s='i.status')}
            ELSE 'not_started' END AS raw,
       st.staging, st.intermediate, st.analytics, st.powerbi
FROM tm_ingestion i
LEFT JOIN lg_stages st ON st.run_id = i.run_id
                      AND st.dataset = split_part(i.source_table, '.', -1)""")

O.cte("k_ds_quality", ["k_run_tests", "tm_ingestion"], f"""
SELECT t.run_id, d.dataset_name, {_AGG}
FROM k_run_tests t
JOIN (SELECT DISTINCT run_id, split_part(source_table, '.', -1) AS dataset_name
      FROM tm_ingestion) d ON d.run_id = t.run_id
WHERE list_bool_or(list_transform(t.depends_on, lambda x: contains(lower(x), lower(d.dataset_name))))
GROUP BY 1, 2""")

O.cte("k_run_datasets", ["k_ds_base", "k_ds_quality"], f"""
SELECT run_id, source_table AS dataset, source_row_count, raw_row_count, minio_object,
       file_size_bytes, started_at, minio_uploaded_at, raw_loaded_at, duration_seconds,
       error_message, source, minio, raw, staging, intermediate, analytics, powerbi,
       {_AGG_VALUE} AS status,
       CASE WHEN COALESCE(q_failed, false) THEN 'quality_failed'
            WHEN COALESCE(q_warning, false) THEN 'quality_warning' END AS status_reason
FROM (
  SELECT b.*, q.any_failed AS q_failed, q.any_warning AS q_warning,
         1 + COALESCE(q.n, 0) AS n,
         tech = 'failed' OR COALESCE(q.any_failed, false) AS any_failed,
         tech = 'running' OR COALESCE(q.any_running, false) AS any_running,
         tech IN ('warning', 'blocked') OR COALESCE(q.any_warning, false) AS any_warning,
         CAST(tech <> 'not_applicable' AS INTEGER) + COALESCE(q.applicable, 0) AS applicable,
         CAST(tech IN ('not_started', 'unmonitored') AS INTEGER) + COALESCE(q.idle, 0) AS idle,
         CAST(tech = 'success' AS INTEGER) + COALESCE(q.succeeded, 0) AS succeeded
  FROM (SELECT *, {_TECH} AS tech FROM k_ds_base) b
  LEFT JOIN k_ds_quality q ON q.run_id = b.run_id AND q.dataset_name = b.dataset_name) c""")


@register("run_datasets", O.sql("SELECT * FROM k_run_datasets", "k_run_datasets"))
def run_datasets(spark, sf_dir):
    """K-5 / J-20 / L-2 / L-3: every dataset of every run with stage statuses,
    combined technical + quality status and the reason."""
    return reports.run_datasets(_tm(spark, sf_dir))


O.cte("k_run_detail", ["k_run_datasets", "k_run_tests", "tm_pipeline"], f"""
SELECT r.run_id, p.started_at, p.finished_at, p.duration_seconds,
       {_TRIGGER.replace('run_id', 'r.run_id')} AS trigger_type,
       CASE WHEN p.run_id IS NOT NULL THEN {_NORM.format(s='p.status')}
            WHEN COALESCE(a.n_failed, 0) > 0 THEN 'failed' ELSE 'success' END AS status,
       p.error_message,
       CAST(COALESCE(a.n_failed, 0) AS BIGINT) AS affected_datasets,
       CAST(COALESCE(t.failed_tests, 0) AS BIGINT) AS failed_tests,
       CAST(COALESCE(t.invalid_records, 0) AS BIGINT) AS invalid_records,
       CASE WHEN COALESCE(a.n_failed, 0) > 0 THEN 'dataset'
            WHEN COALESCE(t.failed_tests, 0) > 0 THEN 'quality'
            WHEN (CASE WHEN p.run_id IS NOT NULL THEN {_NORM.format(s='p.status')}
                       ELSE 'success' END) = 'failed' THEN 'orchestration' END AS failure_scope
FROM (SELECT run_id FROM k_run_datasets UNION SELECT run_id FROM tm_pipeline) r
LEFT JOIN tm_pipeline p ON p.run_id = r.run_id
LEFT JOIN (SELECT run_id, count(*) AS n_failed FROM k_run_datasets
           WHERE status = 'failed' AND NOT COALESCE(status_reason = 'quality_failed', false)
           GROUP BY 1) a ON a.run_id = r.run_id
LEFT JOIN (SELECT run_id, count(*) AS failed_tests, sum(COALESCE(failures, 0)) AS invalid_records
           FROM k_run_tests WHERE {_NORM.format(s='status')} IN ('failed', 'warning')
           GROUP BY 1) t ON t.run_id = r.run_id""")


@register("run_detail", O.sql("SELECT * FROM k_run_detail", "k_run_detail"))
def run_detail(spark, sf_dir):
    """K-4: per run, affected datasets, failed/warned tests, invalid records
    (A-19) and the failure scope (dataset > quality > orchestration)."""
    return reports.run_detail(_tm(spark, sf_dir))


@register("run_failed_tests", O.sql(f"""
SELECT run_id, test_name, test_type, status, failures AS failed_records, execution_seconds,
       message AS error_message, depends_on, owner_name, owner_email
FROM k_run_tests WHERE {_NORM.format(s='status')} IN ('failed', 'warning')""", "k_run_tests"))
def run_failed_tests(spark, sf_dir):
    """K-4: the failed and warning tests of every run."""
    return reports.run_failed_tests(_tm(spark, sf_dir))


@register("run_affected_datasets", O.sql("""
SELECT run_id, dataset, error_message, source, minio, raw, staging, intermediate, analytics
FROM k_run_datasets
WHERE status = 'failed' AND NOT COALESCE(status_reason = 'quality_failed', false)""",
                                         "k_run_datasets"))
def run_affected_datasets(spark, sf_dir):
    """K-4: the datasets of every run that failed technically."""
    return reports.run_affected_datasets(_tm(spark, sf_dir))


@register("dataset_detail", O.sql(f"""
SELECT i.source_table AS dataset, i.run_id, i.started_at, i.finished_at, i.source_row_count,
       i.raw_row_count, i.minio_uploaded_at, i.raw_loaded_at, i.status, i.error_message,
       c.status AS freshness_status, c.max_loaded_at, c.snapshotted_at, c.age_seconds,
       {_NORM.format(s='i.status')} AS source,
       CASE WHEN i.minio_uploaded_at IS NOT NULL THEN {_NORM.format(s='i.status')}
            ELSE 'not_started' END AS minio,
       CASE WHEN i.raw_loaded_at IS NOT NULL THEN {_NORM.format(s='i.status')}
            ELSE 'not_started' END AS raw,
       st.staging, st.intermediate, st.analytics, st.powerbi
FROM (SELECT *, split_part(source_table, '.', -1) AS table_name FROM tm_ingestion
      QUALIFY row_number() OVER (PARTITION BY source_table
                                 ORDER BY started_at DESC, run_id DESC) = 1) i
LEFT JOIN (SELECT * FROM tm_checks QUALIFY row_number() OVER (
             PARTITION BY table_name ORDER BY snapshotted_at DESC, invocation_id DESC) = 1) c
  ON c.table_name = i.table_name
LEFT JOIN lg_stages st ON st.run_id = i.run_id AND st.dataset = i.table_name""",
                                  "tm_ingestion", "tm_checks", "lg_stages"))
def dataset_detail(spark, sf_dir):
    """K-7: newest load, freshness check and stages of every dataset."""
    return reports.dataset_detail(_tm(spark, sf_dir))


@register("dataset_labels", O.sql(f"""
SELECT d.run_id, d.dataset,
       CASE WHEN COALESCE(f.rel_failed, false) THEN 'failed'
            WHEN COALESCE(f.rel_warning, false) THEN 'warning'
            WHEN d.status IN ('failed', 'blocked', 'not_started') THEN 'not_started'
            ELSE d.status END AS display_status,
       CASE WHEN COALESCE(f.rel_failed, false) THEN '{reports.LABEL_QUALITY_FAILED}'
            WHEN COALESCE(f.rel_warning, false) THEN '{reports.LABEL_QUALITY_WARNING}'
            WHEN d.status IN ('failed', 'blocked', 'not_started')
              THEN '{reports.LABEL_NOT_PROCESSED}'
            WHEN rd.status = 'failed' AND rd.failure_scope = 'orchestration'
                 AND d.status = 'success' THEN '{reports.LABEL_PROCESSED}' END AS label
FROM k_run_datasets d
LEFT JOIN k_run_detail rd USING (run_id)
LEFT JOIN (
  SELECT t.run_id, n.dataset_name,
         bool_or(lower(t.status) IN ('error', 'fail', 'failed', 'runtime error')) AS rel_failed,
         bool_or(lower(t.status) IN ('warn', 'warning')) AS rel_warning
  FROM k_run_tests t
  JOIN (SELECT DISTINCT run_id, lower(split_part(dataset, '.', -1)) AS dataset_name
        FROM k_run_datasets) n ON n.run_id = t.run_id
  WHERE {_NORM.format(s='t.status')} IN ('failed', 'warning')
    AND contains(lower(array_to_string(t.depends_on, ',')), n.dataset_name)
  GROUP BY 1, 2) f
  ON f.run_id = d.run_id AND f.dataset_name = lower(split_part(d.dataset, '.', -1))""",
                                 "k_run_datasets", "k_run_detail", "k_run_tests"))
def dataset_labels(spark, sf_dir):
    """K-15: displayed status and label of each dataset in each run."""
    return reports.dataset_labels(_tm(spark, sf_dir))


@register("dataset_history", O.sql("""
SELECT run_id, started_at, finished_at, source_row_count, raw_row_count, minio_object,
       file_size_bytes, duration_seconds, status, error_message
FROM tm_ingestion
WHERE replace(source_table, '.', '_') = 'sales_customer' OR source_table = 'sales_customer'
ORDER BY started_at DESC LIMIT 50""", "tm_ingestion"))
def dataset_history(spark, sf_dir):
    """K-8 / P-19: load history of ``sales_customer`` (two-form name match)."""
    return reports.dataset_history(_tm(spark, sf_dir), "sales_customer", 50)


@register("dataset_search", O.sql("""
SELECT * FROM k_run_datasets WHERE contains(lower(dataset), 'sales') AND status = 'failed'""",
                                  "k_run_datasets"))
def dataset_search(spark, sf_dir):
    """K-14: datasets whose name contains 'sales' with status 'failed'."""
    return reports.search_datasets(reports.run_datasets(_tm(spark, sf_dir)), "sales", "failed")


# ------------------------------------------------------------ platform status
_PS_STAGES = ["source", "minio", "raw", "staging", "intermediate", "analytics", "tests"]


def _any(words):
    return "(" + " OR ".join(f"stage_{s} IN ({', '.join(repr(w) for w in words)})"
                             for s in _PS_STAGES) + ")"


def _platform_sql(pipeline: str) -> str:
    """K-1 over one of the pipeline tables; the chain of fallbacks is spelt out:
    pipeline, else orchestrated test run, else load."""
    k = f"k_{pipeline}"
    target = f"(SELECT run_id FROM {pipeline} ORDER BY started_at DESC, run_id DESC LIMIT 1)"
    O.cte(k, [pipeline, "tm_ingestion", "tm_runs", "tm_checks", "tm_nodes", "lg_nodes",
              "lg_stages"], f"""
SELECT t.*, i.*, d.*, f.*, l.*, y.*, m.*
FROM (SELECT {target} AS t_run) t0
LEFT JOIN (SELECT run_id AS t_run, status AS t_status, duration_seconds AS t_duration
           FROM {pipeline}) t ON t.t_run = t0.t_run
LEFT JOIN (SELECT run_id AS i_run, bool_and(status = 'success') AS i_ok,
                  bool_and(source_row_count IS NOT NULL) AS i_src,
                  bool_and(minio_uploaded_at IS NOT NULL) AS i_minio,
                  bool_and(raw_loaded_at IS NOT NULL) AS i_raw,
                  CAST(sum(duration_seconds) AS DECIMAL(38,3)) AS i_duration
           FROM tm_ingestion WHERE {target} IS NULL OR run_id = {target}
           GROUP BY run_id ORDER BY max(started_at) DESC, run_id DESC LIMIT 1) i ON true
CROSS JOIN (SELECT max(orchestrator_run_id) AS d_run,
                   CASE WHEN count(*) = 0 THEN NULL
                        WHEN bool_or(status IN ('error', 'failed')) THEN 'error'
                        WHEN bool_or(status IN ('warn', 'warning')) THEN 'warn'
                        ELSE 'success' END AS d_status,
                   sum(elapsed_seconds) AS d_elapsed,
                   CAST(COALESCE(sum(test_nodes), 0) AS BIGINT) AS tests_total,
                   CAST(COALESCE(sum(failed_tests), 0) AS BIGINT) AS d_failed
            FROM tm_runs WHERE orchestrator_run_id = COALESCE({target}, {_LATEST_RUN})) d
CROSS JOIN (SELECT max(age_seconds) FILTER (WHERE freshness_type = 'technical')
                     AS technical_freshness_seconds,
                   max(max_loaded_at) FILTER (WHERE freshness_type = 'business')
                     AS last_business_event_at
            FROM tm_checks WHERE invocation_id = (
              SELECT invocation_id FROM tm_checks
              WHERE {target} IS NULL OR orchestrator_run_id = {target}
              ORDER BY collected_at DESC, invocation_id DESC LIMIT 1)) f
CROSS JOIN (SELECT max(finished_at) AS last_successful_run FROM {pipeline}
            WHERE status = 'success' AND finished_at IS NOT NULL) l
CROSS JOIN (SELECT max(CASE WHEN layer = 'staging' THEN v END) AS ly_staging,
                   max(CASE WHEN layer = 'intermediate' THEN v END) AS ly_intermediate,
                   max(CASE WHEN layer = 'analytics' THEN v END) AS ly_analytics
            FROM (SELECT layer, {_AGG_VALUE} AS v
                  FROM (SELECT n.layer, {_AGG}
                        FROM tm_nodes e JOIN lg_nodes n ON n.node_unique_id = e.node_unique_id
                          AND n.trial = starts_with(e.orchestrator_run_id, 'manual__')
                        WHERE e.orchestrator_run_id = {target} AND n.layer IS NOT NULL
                        GROUP BY n.layer) a) b) y
CROSS JOIN (SELECT CAST(count(*) FILTER (WHERE 'failed' IN (staging, intermediate, analytics,
                                                            powerbi)) AS BIGINT)
                     AS datasets_impacted
            FROM lg_stages WHERE run_id = {target}) m""")
    steps = [f"""*, CASE WHEN i_run IS NULL THEN 'not_started' WHEN i_ok THEN 'success'
                     ELSE 'failed' END AS ing_status""",
             """*, CASE WHEN i_src THEN ing_status WHEN ing_status = 'failed' THEN 'failed'
            ELSE 'not_started' END AS stage_source""",
             """*, CASE WHEN i_minio THEN ing_status WHEN stage_source = 'failed' THEN 'blocked'
               ELSE 'not_started' END AS stage_minio""",
             """*, CASE WHEN i_raw THEN ing_status WHEN stage_minio IN ('failed', 'blocked')
               THEN 'blocked' ELSE 'not_started' END AS stage_raw"""]
    for layer, before in (("staging", "raw"), ("intermediate", "staging"),
                          ("analytics", "intermediate")):
        steps.append(f"""*, CASE WHEN COALESCE(ly_{layer}, 'not_started') = 'not_started'
                    AND stage_{before} IN ('failed', 'blocked') THEN 'blocked'
               ELSE COALESCE(ly_{layer}, 'not_started') END AS stage_{layer}""")
    steps.append(f"""*, {_NORM.format(s='d_status')} AS stage_tests,
       'unmonitored' AS stage_powerbi, {_NORM.format(s='t_status')} AS p_status,
       COALESCE(t_run, d_run, i_run) AS any_run""")
    inner = k
    for i, step in enumerate(steps):
        O.cte(f"{k}_{i}", [inner], f"SELECT {step} FROM {inner}")
        inner = f"{k}_{i}"
    return O.sql(f"""
SELECT CASE WHEN p_status = 'failed' OR {_any(['failed'])} THEN 'failed'
            WHEN p_status = 'running' OR {_any(['running'])} THEN 'running'
            WHEN {_any(['warning', 'blocked'])} THEN 'warning'
            WHEN NOT {_any(['failed', 'running', 'warning', 'blocked', 'not_started',
                             'unmonitored'])} THEN 'success'
            ELSE 'not_started' END AS platform_status,
       any_run AS run_id, {_TRIGGER.replace('run_id', 'any_run')} AS trigger_type,
       last_successful_run,
       CASE WHEN t_run IS NOT NULL THEN COALESCE(CAST(t_duration AS DOUBLE), 0.0)
            ELSE COALESCE(CAST(i_duration AS DOUBLE), 0.0)
                 + COALESCE(CAST(d_elapsed AS DOUBLE), 0.0) END AS pipeline_duration_seconds,
       CAST(technical_freshness_seconds AS DOUBLE) AS technical_freshness_seconds,
       last_business_event_at,
       tests_total - d_failed AS tests_passed, tests_total,
       CASE WHEN p_status = 'failed' OR {_any(['failed'])} THEN 1 ELSE 0 END AS failed_pipelines,
       datasets_impacted,
       stage_source, stage_minio, stage_raw, stage_staging, stage_intermediate,
       stage_analytics, stage_tests, stage_powerbi
FROM {inner}""", inner)


_PLATFORM_SQL = _platform_sql("tm_pipeline")


@register("platform_status", _PLATFORM_SQL)
def platform_status(spark, sf_dir):
    """K-1 / A-7 / A-8 / A-9 / J-21: one-row status of the latest run with its
    canonical stage list, tests, freshness and impacted datasets."""
    return reports.platform_status(_tm(spark, sf_dir))


@register("platform_status_unfinished", _platform_sql("tm_pipeline_unfinished"))
def platform_status_unfinished(spark, sf_dir):
    """K-1 while the newest run still goes on: no duration, status running unless a
    stage failed."""
    tm = _tm(spark, sf_dir)
    return reports.platform_status(tm, tm.unfinished_pipeline_runs)


@register("platform_status_unrecorded", _platform_sql("tm_pipeline_unrecorded"))
def platform_status_unrecorded(spark, sf_dir):
    """K-1 without any pipeline row: the newest test run and load stand in."""
    tm = _tm(spark, sf_dir)
    return reports.platform_status(tm, tm.pipeline_runs.where("false"))


_SUMMARY_STAGES = [*_PS_STAGES, "powerbi"]


@register("latest_run_summary", f"""
SELECT run_id, 'sales_star_pipeline' AS pipeline, platform_status AS status,
       unnest({_list(_SUMMARY_STAGES)}) AS stage,
       unnest([{', '.join('stage_' + s for s in _SUMMARY_STAGES)}]) AS stage_status
FROM ({_PLATFORM_SQL}) p""")
def latest_run_summary(spark, sf_dir):
    """K-2: the latest run's id and status with a row for each stage."""
    summary = reports.latest_run_summary(reports.platform_status(_tm(spark, sf_dir)))
    return summary.selectExpr("run_id", "pipeline", "status", "explode(stages)").toDF(
        "run_id", "pipeline", "status", "stage", "stage_status")


_RULE = "assert_sales_order_subtotals_match"
_CAPTURED = dt.datetime(2025, 6, 30)


@register("quality_evidence", O.sql(f"""
SELECT TIMESTAMP '{_CAPTURED:%Y-%m-%d %H:%M:%S}' AS captured_at, *
FROM ({SINGULAR_SQL[_RULE][0]}) f
ORDER BY CAST(sales_order_id AS VARCHAR) || ',' LIMIT 100""", *SINGULAR_SQL[_RULE][1]))
def quality_evidence(spark, sf_dir):
    """K-12 / Q-7 / S-11 / F-27: the failing rows of the subtotal reconciliation are
    captured twice, another test's first with rows and then without; the newest 100
    records of the first are read back from the store."""
    wh = Warehouse.from_driver(spark, sf_dir)
    failing = singular_failures(_RULE, wh)
    store = f"{checkpoint_dir(spark)}/starwright-evidence/{uuid.uuid4().hex}"
    for at in (_CAPTURED - dt.timedelta(hours=1), _CAPTURED):
        evidence.capture(failing, "inv-latest", _RULE, at, store)
        evidence.capture(failing.where(F.lit(at < _CAPTURED)), "inv-latest", "other", at, store)
    kept = evidence.evidence(spark, store)
    found = reports.quality_evidence(kept, "inv-latest", _RULE, 100)
    return found.select("captured_at", F.from_json("failure_record", failing.schema).alias("r")) \
        .select("captured_at", "r.*")


# --------------------------------------------------------------- constraints
def _constraint_sql(model: str, table: str) -> str:
    parts = [f"""SELECT '{model}' AS model, '{model}_{c}_not_null' AS constraint_name,
       'not_null' AS kind, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations
FROM {table}""" for c in constraints.NOT_NULL[model]]
    key = constraints.PRIMARY[model]
    parts.append(f"""SELECT '{model}', '{model}_{key}_pk', 'primary_key',
       CAST(count(*) - count(DISTINCT {key}) AS BIGINT) FROM {table}""")
    parts += [f"""SELECT '{model}', '{model}_{c}_fk', 'foreign_key', CAST(count(*) AS BIGINT)
FROM {table} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL)"""
              for c, (p, k) in constraints.FOREIGN.get(model, {}).items()]
    return "\nUNION ALL\n".join(parts)


_PARENTS = sorted({p for own in constraints.FOREIGN.values() for p, _ in own.values()})


@register("constraint_violations", O.sql(
    "\nUNION ALL\n".join(_constraint_sql(m, m) for m in sorted(constraints.PRIMARY)),
    *sorted({*constraints.PRIMARY, *_PARENTS})))
def constraint_violations(spark, sf_dir):
    """Q-6: violations of all 91 declared constraints of the table models."""
    wh = Warehouse.from_driver(spark, sf_dir)
    return union_all([constraints.constraint_violations(m, wh.model(m), wh.model)
                      for m in sorted(constraints.PRIMARY)])


O.cte("broken_fact", ["fact_sales"], """
SELECT * REPLACE (
  CASE WHEN sales_order_detail_id % 97 = 0 THEN product_id + 1000000000000 ELSE product_id END
    AS product_id,
  CASE WHEN sales_order_detail_id % 89 = 0 THEN NULL ELSE order_status END AS order_status)
FROM fact_sales
UNION ALL SELECT * FROM fact_sales WHERE sales_order_detail_id % 7 = 0""")


@register("constraint_violations_broken", O.sql(_constraint_sql("fact_sales", "broken_fact"),
                                                "broken_fact", *_PARENTS))
def constraint_violations_broken(spark, sf_dir):
    """Q-6 over the whole fact with faults planted: repeated keys, products that
    don't exist and missing states."""
    wh = Warehouse.from_driver(spark, sf_dir)
    fact, key = wh.model("fact_sales"), F.col("sales_order_detail_id")
    broken = fact.withColumns({
        "product_id": F.when(key % 97 == 0, F.col("product_id") + 1000000000000)
        .otherwise(F.col("product_id")),
        "order_status": F.when(key % 89 != 0, F.col("order_status"))}).unionAll(
        fact.where(key % 7 == 0))
    return constraints.constraint_violations("fact_sales", broken, wh.model)
