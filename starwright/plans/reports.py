"""Observability read queries (K-1 … K-15) over the telemetry tables.

The reference answers these one HTTP request at a time, some with an N+1 loop
over datasets; here each is one lazy plan over *all* runs/datasets, with the
dataset or run as a join/group key.  "Latest" selections are scalar subqueries
expressed as ``orderBy(desc).limit(1)`` (TakeOrdered, one row) cross-joined
back, never a driver round trip.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.columns import last_dotted, normalize_status, trigger_type
from starwright.operators.closure import graph_of_run, reachable
from starwright.plans.telemetry import (
    Telemetry, aggregate_status, aggregate_status_value,
)

LAYERS = ["staging", "intermediate", "analytics"]
DEFAULT_SLA_MINUTES = 1440


# unique key of each telemetry table, used to break ties in "latest" picks so
# every branch that reuses the one-row subquery sees the same row
_TIE_BREAK = ["run_id", "invocation_id", "orchestrator_run_id"]


def latest(df: DataFrame, ts: str, *cols) -> DataFrame:
    """One-row scalar subquery: ``select cols order by ts desc limit 1``
    (TakeOrdered), with the table's key as a deterministic tie-breaker."""
    keys = [F.col(k).desc() for k in _TIE_BREAK if k in df.columns]
    return df.orderBy(F.col(ts).desc(), *keys).limit(1).select(*cols)


def run_history(tm: Telemetry, limit: int = 20) -> DataFrame:
    """K-3: newest runs with their dataset count and trigger type."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be within 1..100")
    p = tm.pipeline_runs
    counts = tm.ingestion_runs.groupBy("run_id").agg(
        F.count("source_table").cast("bigint").alias("dataset_count"))
    return (
        p.join(counts, "run_id", "left")
        .select("run_id", "started_at", "finished_at", "duration_seconds", "status",
                "error_message",
                F.coalesce("dataset_count", F.lit(0)).cast("bigint").alias("dataset_count"),
                trigger_type("run_id").alias("trigger_type"))
        .orderBy(F.col("started_at").desc()).limit(limit)
    )


def optional_eq(column: str, value) -> "Column":
    """P-18: ``(:p is null or col = :p)`` — no filter when the parameter is absent."""
    return F.lit(True) if value is None else (F.col(column) == F.lit(value))


def ingestion_rollup(tm: Telemetry, run_id: str | None = None) -> DataFrame:
    """A-7: per run (or only ``run_id``), whether every dataset loaded and
    reached each stage."""
    return tm.ingestion_runs.where(optional_eq("run_id", run_id)).groupBy("run_id").agg(
        F.max("finished_at").alias("finished_at"),
        F.sum("duration_seconds").cast("decimal(38,3)").alias("duration_seconds"),
        F.bool_and(F.col("status") == "success").alias("successful"),
        F.bool_and(F.col("source_row_count").isNotNull()).alias("source_complete"),
        F.bool_and(F.col("minio_uploaded_at").isNotNull()).alias("minio_complete"),
        F.bool_and(F.col("raw_loaded_at").isNotNull()).alias("raw_complete"),
        F.count(F.lit(1)).cast("bigint").alias("datasets"),
    )


def dbt_run_rollup(tm: Telemetry) -> DataFrame:
    """A-8: per orchestrator run, status roll-up of its invocations."""
    r = tm.dbt_runs
    return r.groupBy("orchestrator_run_id").agg(
        F.max("collected_at").alias("collected_at"),
        F.when(F.bool_or(F.col("status").isin("error", "failed")), "error")
        .when(F.bool_or(F.col("status").isin("warn", "warning")), "warn")
        .otherwise("success").alias("status"),
        F.sum("elapsed_seconds").cast("decimal(38,3)").alias("elapsed_seconds"),
        F.sum("test_nodes").cast("bigint").alias("test_nodes"),
        F.sum("failed_tests").cast("bigint").alias("failed_tests"),
    )


def run_tests(tm: Telemetry, run_id: str | None = None) -> DataFrame:
    """K-6: tests of a run (default: the latest orchestrated run), ordered by
    ``status desc, test_name``."""
    runs = tm.dbt_runs
    if run_id is None:
        target = latest(runs.where(F.col("orchestrator_run_id").isNotNull()), "collected_at",
                        F.col("orchestrator_run_id").alias("__run"))
    else:
        target = runs.sparkSession.createDataFrame([(run_id,)], "__run string")
    sel = runs.join(F.broadcast(target), F.col("orchestrator_run_id") == F.col("__run"))
    t = tm.test_results.drop("orchestrator_run_id")
    return (
        t.join(sel.select("invocation_id"), "invocation_id")
        .select("test_name", "test_type", "status",
                F.col("failures").alias("failed_records"), "execution_seconds",
                F.col("message").alias("error_message"), "depends_on", "owner_name", "owner_email")
        .orderBy(F.col("status").desc(), "test_name")
    )


def data_quality_summary(tm: Telemetry) -> DataFrame:
    """K-11 / A-18: passed / warning / failed counts of the latest orchestrated run."""
    runs = tm.dbt_runs.where(F.col("orchestrator_run_id").isNotNull())
    target = latest(runs, "collected_at", F.col("orchestrator_run_id").alias("__run"),
                    "generated_at", "collected_at")
    invs = runs.join(F.broadcast(target.select("__run")),
                     F.col("orchestrator_run_id") == F.col("__run")).select("invocation_id")
    s = normalize_status("status")
    counts = tm.test_results.join(invs, "invocation_id", "left_semi").agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(s == "success").cast("bigint").alias("passed"),
        F.count_if(s == "warning").cast("bigint").alias("warnings"),
        F.count_if(s == "failed").cast("bigint").alias("failed"),
    )
    return target.crossJoin(counts).select(
        F.coalesce("generated_at", "collected_at").alias("last_run_at"),
        F.col("__run").alias("run_id"), "total", "passed", "warnings", "failed",
    )


def data_quality_results(tm: Telemetry) -> DataFrame:
    """K-11, its rows: every test result of the latest orchestrated run with owner."""
    runs = tm.dbt_runs.where(F.col("orchestrator_run_id").isNotNull())
    target = latest(runs, "collected_at", F.col("orchestrator_run_id").alias("__run"))
    invocations = runs.join(F.broadcast(target), F.col("orchestrator_run_id") == F.col("__run"))
    return tm.test_results.join(invocations.select("invocation_id"), "invocation_id", "left_semi") \
        .select("invocation_id", "test_unique_id", "test_name", "test_type", "severity", "status",
                F.col("failures").alias("failed_records"), "execution_seconds", "message",
                "depends_on", "owner_group", "owner_name", "owner_email") \
        .orderBy(F.col("status").desc(), "test_name")


def dependency_index(tm: Telemetry) -> DataFrame:
    """J-20 (memoised per telemetry instance, persisted with its tables)."""
    if "dependency_index" not in tm.__dict__:
        tm.__dict__["dependency_index"] = tm.persist("dependency_index", _dependency_index(tm))
    return tm.__dict__["dependency_index"]


def _dependency_index(tm: Telemetry) -> DataFrame:
    """J-20: (depends_on, dataset) for every distinct dependency list that mentions
    a dataset's name, in any case and anywhere in a dependency ('person' is in
    'salesperson').  Every substring of the distinct lists' entries that is as long
    as a name meets the names by equality, so neither tests nor runs are paired
    with all datasets; the lists are as few as the manifest's nodes."""
    names = tm.ingestion_runs.select(F.lower(last_dotted("source_table")).alias("name")) \
        .distinct().withColumn("size", F.length("name"))
    entries = tm.test_results.select("depends_on").distinct().select(
        "depends_on", F.explode("depends_on").alias("entry")).withColumn("entry", F.lower("entry"))
    longest = names.agg(F.max("size").alias("longest"))
    starts = entries.where("entry <> ''").crossJoin(F.broadcast(longest)).select(   # one row
        "depends_on", "entry", "longest", F.expr("explode(sequence(1, length(entry)))").alias("at"))
    parts = starts.select("depends_on", F.expr(
        "explode(transform(sequence(1, least(longest, length(entry) - at + 1)), "
        "n -> substring(entry, at, n)))").alias("name"))
    return parts.join(names, "name").select("depends_on", F.col("name").alias("dataset")).distinct()


def latest_test_results(tm: Telemetry, per_dataset: int = 50) -> DataFrame:
    """K-7 / W-1: for every dataset, the latest result of each test that
    depends on it (``distinct on … order by collected_at desc``), at most
    ``per_dataset`` per dataset ordered by ``status desc, test_name``."""
    t = tm.test_results.join(tm.dbt_runs.select("invocation_id", F.col("collected_at")
                                                .alias("run_collected_at")), "invocation_id")
    # latest per test as a max_by aggregate, before any dataset is met: partial
    # aggregation keeps one candidate per task even when one test has a huge history
    fields = ["invocation_id", "test_name", "test_type", "severity", "status", "failures",
              "message", "execution_seconds", "depends_on"]
    newest = t.groupBy("test_unique_id", "depends_on").agg(
        F.max_by(F.struct(*[f for f in fields if f != "depends_on"]),
                 F.struct("run_collected_at", "collected_at", "invocation_id"))
        .alias("r"), F.max(F.struct("run_collected_at", "collected_at", "invocation_id"))
        .alias("at"))
    matched = newest.join(dependency_index(tm), "depends_on").groupBy(
        "dataset", "test_unique_id").agg(F.max_by("r", "at").alias("r")).select(
        "dataset", "test_unique_id", "r.*")
    w2 = Window.partitionBy("dataset").orderBy(F.col("status").desc(), "test_name")
    return matched.withColumn("__k", F.row_number().over(w2)).where(F.col("__k") <= per_dataset) \
        .select("dataset", "invocation_id", "test_unique_id", "test_name", "test_type",
                "severity", "status", "failures", "message", "execution_seconds")


def dataset_detail(tm: Telemetry) -> DataFrame:
    """K-7: for every dataset ever loaded, its newest load, its newest freshness
    check and the stages of that load's run (its tests: ``latest_test_results``)."""
    load = ["run_id", "started_at", "finished_at", "source_row_count", "raw_row_count",
            "minio_uploaded_at", "raw_loaded_at", "status", "error_message"]
    newest = tm.ingestion_runs.groupBy("source_table").agg(
        F.max_by(F.struct(*load), F.struct("started_at", "run_id")).alias("r")).select(
        "source_table", last_dotted("source_table").alias("table_name"), "r.*")
    checks = tm.freshness_results.groupBy("table_name").agg(
        F.max_by(F.struct("status", "max_loaded_at", "snapshotted_at", "age_seconds"),
                 F.struct("snapshotted_at", "invocation_id")).alias("f")).select(
        "table_name", F.col("f.status").alias("freshness_status"), "f.max_loaded_at",
        "f.snapshotted_at", "f.age_seconds")
    stages = dataset_stage_status(tm).withColumnRenamed("dataset", "table_name")
    state = normalize_status("status")
    return newest.join(checks, "table_name", "left").join(
        stages, ["run_id", "table_name"], "left").select(
        F.col("source_table").alias("dataset"), *load, "freshness_status", "max_loaded_at",
        "snapshotted_at", "age_seconds", state.alias("source"),
        F.when(F.col("minio_uploaded_at").isNotNull(), state).otherwise("not_started")
        .alias("minio"),
        F.when(F.col("raw_loaded_at").isNotNull(), state).otherwise("not_started").alias("raw"),
        *LAYERS, "powerbi")


def incidents(tm: Telemetry, limit: int = 100) -> DataFrame:
    """K-13 / U-2: failed ingestions and failed tests, newest first."""
    ing = tm.ingestion_runs.where(F.col("status") == "failed").select(
        "run_id", F.col("finished_at").alias("occurred_at"),
        F.lit("ingestion").alias("origin"),
        F.concat(F.lit("Ingestion: "), F.col("source_table")).alias("test_name"),
        F.lit("error").alias("severity"), "status",
        F.lit(None).cast("bigint").alias("invalid_records"),
        F.col("error_message").alias("error"),
        F.array("source_table").alias("depends_on"),
        F.lit(None).cast("string").alias("owner_name"),
        F.lit(None).cast("string").alias("owner_email"),
    )
    r = tm.dbt_runs.select("invocation_id", "collected_at",
                           F.col("orchestrator_run_id").alias("run_id"))
    tst = tm.test_results.drop("orchestrator_run_id", "collected_at").join(r, "invocation_id") \
        .where(F.lower("status").isin("error", "fail", "failed", "runtime error")).select(
            "run_id", F.col("collected_at").alias("occurred_at"),
            F.lit("dbt_test").alias("origin"), "test_name", "severity", "status",
            F.col("failures").alias("invalid_records"), F.col("message").alias("error"),
            "depends_on", "owner_name", "owner_email",
        )
    return ing.unionByName(tst).orderBy(
        F.col("occurred_at").desc_nulls_first(), "origin", "test_name", "run_id"
    ).limit(limit)


def dataset_freshness(tm: Telemetry, checked_at: dt.datetime,
                      sla_minutes: int = DEFAULT_SLA_MINUTES) -> DataFrame:
    """B-4 + K-9: per dataset of the latest run, freshness against the SLA.

    ``analytics_updated_at`` is set when the run succeeded (B-5's update of all
    the run's datasets); no warehouse time → failed, no analytics time →
    warning, older than the SLA → warning, else the stored status."""
    p = tm.pipeline_runs
    target = latest(p, "started_at", F.col("run_id").alias("__run"))
    ing = tm.ingestion_runs.join(F.broadcast(target), F.col("run_id") == F.col("__run"))
    runs = p.select("run_id", F.col("status").alias("__pstatus"),
                    F.col("finished_at").alias("__pfinished"))
    j = ing.join(runs, "run_id", "left")
    now = F.lit(checked_at).cast("timestamp_ntz")
    analytics = F.when(F.col("__pstatus") == "success", F.col("__pfinished"))
    age_min = F.expr("timestampdiff(SECOND, analytics_updated_at, __now)") / 60
    out = j.select(
        F.col("source_table").alias("dataset"),
        F.col("started_at").alias("source_updated_at"),
        F.col("minio_uploaded_at").alias("minio_updated_at"),
        F.col("raw_loaded_at").alias("warehouse_updated_at"),
        analytics.alias("analytics_updated_at"),
        F.lit(sla_minutes).alias("sla_minutes"),
        F.col("status").alias("stored_status"),
        now.alias("__now"),
    )
    return out.select(
        "dataset", "source_updated_at", "minio_updated_at", "warehouse_updated_at",
        "analytics_updated_at", "sla_minutes",
        F.when(F.col("warehouse_updated_at").isNull(), "failed")
        .when(F.col("analytics_updated_at").isNull(), "warning")
        .when(age_min > F.col("sla_minutes"), "warning")
        .otherwise(F.col("stored_status")).alias("status"),
    )


# ----------------------------------------------------------------- lineage
def run_graphs(tm: Telemetry) -> DataFrame:
    """(orchestrator_run_id, graph): which manifest each run ran."""
    if "graphs" not in tm.__dict__:
        tm.__dict__["graphs"] = tm.persist("run_graphs", graph_of_run(tm.run_nodes))
    return tm.__dict__["graphs"]


def graph_nodes(tm: Telemetry) -> DataFrame:
    """The nodes of each distinct manifest, from the first run that has it."""
    first = run_graphs(tm).groupBy("graph").agg(
        F.min("orchestrator_run_id").alias("orchestrator_run_id"))
    return tm.run_nodes.join(first, "orchestrator_run_id").drop("orchestrator_run_id")


def lineage_closure(tm: Telemetry) -> DataFrame:
    """L-1: (graph, source node, descendant node) of every distinct manifest."""
    if "closure" not in tm.__dict__:
        nodes = graph_nodes(tm).select(
            "graph", F.col("node_unique_id").alias("node"),
            (F.col("resource_type") == "source").alias("is_root"), "depends_on")
        tm.__dict__["closure"] = tm.persist("lineage_closure", reachable(nodes))
    return tm.__dict__["closure"]


def dataset_stage_status(tm: Telemetry) -> DataFrame:
    """L-2 (memoised per telemetry instance, persisted with its tables)."""
    if "stages" not in tm.__dict__:
        tm.__dict__["stages"] = tm.persist("dataset_stage_status", _dataset_stage_status(tm))
    return tm.__dict__["stages"]


def _dataset_stage_status(tm: Telemetry) -> DataFrame:
    """L-2: per (run, dataset) the status of each model layer downstream of the
    dataset's source in the run's own manifest, with ``blocked`` propagation and
    the consumer stage."""
    nodes = graph_nodes(tm)
    closure = lineage_closure(tm)
    sources = nodes.where(F.col("resource_type") == "source") \
        .select("graph", F.col("node_unique_id").alias("root"),
                F.col("node_name").alias("dataset"))
    models = nodes.where((F.col("resource_type") == "model") & F.col("layer").isNotNull()) \
        .select("graph", F.col("node_unique_id").alias("node"), "layer")
    # applicable models per manifest, dataset and layer
    applicable = closure.join(sources, ["graph", "root"]).join(models, ["graph", "node"]) \
        .select("graph", "dataset", "layer", "node")
    runs = tm.ingestion_runs.select("run_id", last_dotted("source_table").alias("dataset"))
    ev = tm.node_results.select(F.col("orchestrator_run_id").alias("run_id"),
                                F.col("node_unique_id").alias("node"), "status")
    graphs = run_graphs(tm).withColumnRenamed("orchestrator_run_id", "run_id")
    x = runs.join(graphs, "run_id").join(applicable, ["graph", "dataset"]) \
        .join(ev, ["run_id", "node"], "left")
    per_layer = x.groupBy("run_id", "dataset", "layer").agg(*aggregate_status(F.col("status")))
    per_layer = per_layer.select("run_id", "dataset", "layer",
                                 aggregate_status_value().alias("value"))
    wide = per_layer.groupBy("run_id", "dataset").pivot("layer", LAYERS).agg(F.first("value"))
    wide = runs.distinct().join(wide, ["run_id", "dataset"], "left")
    prev = F.lit("success")
    cols = []
    for layer in LAYERS:
        v = F.coalesce(F.col(layer), F.lit("not_applicable"))
        v = F.when((v == "not_started") & prev.isin("failed", "blocked"), "blocked").otherwise(v)
        cols.append(v.alias(layer))
        prev = F.when(v != "not_applicable", v).otherwise(prev)
    staged = wide.select("run_id", "dataset", *cols)
    return staged.withColumn(
        "powerbi",
        F.when(F.col("analytics") != "not_applicable", "unmonitored").otherwise("not_applicable"),
    )


# --------------------------------------------------------- status helpers
def status_parts(word: "Column") -> list:
    """Aggregate-status parts of one already-normalised status word."""
    s = word
    return [
        F.lit(1).alias("__n"),
        (s == "failed").alias("__failed"),
        (s == "running").alias("__running"),
        s.isin("warning", "blocked").alias("__warning"),
        (s != "not_applicable").cast("int").alias("__applicable"),
        s.isin("not_started", "unmonitored").cast("int").alias("__idle"),
        (s == "success").cast("int").alias("__success"),
    ]


def combine_parts(a: str, b: str) -> list:
    """Sum two sets of aggregate-status parts (prefixes ``a`` and ``b``)."""
    def f(name):
        return F.coalesce(F.col(f"{a}{name}"), F.lit(0)) + F.coalesce(F.col(f"{b}{name}"), F.lit(0))

    def g(name):
        return F.coalesce(F.col(f"{a}{name}"), F.lit(False)) | F.coalesce(F.col(f"{b}{name}"),
                                                                          F.lit(False))
    return [f("__n").alias("__n"), g("__failed").alias("__failed"),
            g("__running").alias("__running"), g("__warning").alias("__warning"),
            f("__applicable").alias("__applicable"), f("__idle").alias("__idle"),
            f("__success").alias("__success")]


def aggregate_status_of(statuses: list) -> "Column":
    """L-3 over a fixed list of already-normalised status columns (all
    evidence present); kept free of re-normalisation so the expression stays
    small when Catalyst inlines it."""
    s = list(statuses)

    def any_(pred):
        return reduce(lambda p, q: p | q, [pred(x) for x in s])

    def count(pred):
        return sum((F.when(pred(x), 1).otherwise(0) for x in s), F.lit(0))

    n_app = count(lambda x: x != "not_applicable")
    n_idle = count(lambda x: x.isin("not_started", "unmonitored"))
    n_ok = count(lambda x: x == "success")
    return (F.when(any_(lambda x: x == "failed"), "failed")
            .when(any_(lambda x: x == "running"), "running")
            .when(any_(lambda x: x.isin("warning", "blocked")), "warning")
            .when((n_app == 0) | (n_app == n_idle), "not_started")
            .when(n_ok == n_app, "success").otherwise("warning"))


PART_NAMES = ["__n", "__failed", "__running", "__warning", "__applicable", "__idle", "__success"]


def _run_tests(tm: Telemetry) -> DataFrame:
    """Test results with their orchestrated run id (J-15)."""
    r = tm.dbt_runs.select("invocation_id", F.col("orchestrator_run_id").alias("run_id"),
                           F.col("collected_at").alias("run_collected_at"))
    return tm.test_results.drop("orchestrator_run_id").join(r, "invocation_id")


MONITORED = ["source", "minio", "raw", "staging", "intermediate", "analytics"]


def run_datasets(tm: Telemetry) -> DataFrame:
    """K-5: every dataset of every run: ingestion fields, stage statuses, the
    combined technical + quality status and the reason."""
    ing = tm.ingestion_runs.withColumn("dataset_name", last_dotted("source_table"))
    ist = normalize_status("status")
    stages = dataset_stage_status(tm).withColumnRenamed("dataset", "dataset_name")
    j = ing.join(stages, ["run_id", "dataset_name"], "left").select(
        "*",
        ist.alias("source"),
        F.when(F.col("minio_uploaded_at").isNotNull(), ist).otherwise("not_started").alias("minio"),
        F.when(F.col("raw_loaded_at").isNotNull(), ist).otherwise("not_started").alias("raw"),
    )
    # J-20: a run's test relates to the datasets that its dependencies mention;
    # flags and counts, never a collected list per group
    related = _run_tests(tm).join(dependency_index(tm), "depends_on")
    q = related.groupBy("run_id", "dataset").agg(*aggregate_status(F.col("status")))
    q = q.select("run_id", F.col("dataset").alias("name"),
                 *[F.col(c).alias("q" + c) for c in PART_NAMES])
    tech = aggregate_status_of([F.col(c) for c in MONITORED])
    x = j.withColumn("name", F.lower("dataset_name")).join(q, ["run_id", "name"], "left") \
        .withColumn("technical_status", tech)
    x = x.select("*", *[c.alias("t" + n) for c, n in
                        zip(status_parts(F.col("technical_status")), PART_NAMES)])
    combined = x.select("*", *combine_parts("t", "q"))
    qs_failed = F.coalesce(F.col("q__failed"), F.lit(False))
    qs_warning = F.coalesce(F.col("q__warning"), F.lit(False))
    return combined.select(
        "run_id", F.col("source_table").alias("dataset"), "source_row_count", "raw_row_count",
        "minio_object", "file_size_bytes", "started_at", "minio_uploaded_at", "raw_loaded_at",
        "duration_seconds", "error_message", *MONITORED, "powerbi",
        aggregate_status_value().alias("status"),
        F.when(qs_failed, "quality_failed").when(qs_warning, "quality_warning")
        .alias("status_reason"),
    )


def run_failed_tests(tm: Telemetry) -> DataFrame:
    """K-4: the failed and warning tests of every run, with owners."""
    return _run_tests(tm).where(normalize_status("status").isin("failed", "warning")).select(
        "run_id", "test_name", "test_type", "status", F.col("failures").alias("failed_records"),
        "execution_seconds", F.col("message").alias("error_message"), "depends_on", "owner_name",
        "owner_email")


def run_affected_datasets(tm: Telemetry) -> DataFrame:
    """K-4: the datasets of every run that failed for another reason than quality."""
    return run_datasets(tm).where(
        (F.col("status") == "failed")
        & ~F.coalesce(F.col("status_reason") == "quality_failed", F.lit(False))).select(
        "run_id", "dataset", "error_message", *MONITORED)


def run_detail(tm: Telemetry) -> DataFrame:
    """K-4: per run, failed datasets (quality-only failures excluded), the
    count of failed/warned tests and the failure scope."""
    ds = run_datasets(tm)
    failed = ds.where((F.col("status") == "failed")
                      & ~F.coalesce(F.col("status_reason") == "quality_failed", F.lit(False)))
    aff = failed.groupBy("run_id").agg(F.count(F.lit(1)).cast("bigint").alias("affected_datasets"))
    ts = normalize_status("status")
    bad_tests = _run_tests(tm).where(ts.isin("failed", "warning")).groupBy("run_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("failed_tests"),
        F.sum(F.coalesce("failures", F.lit(0))).cast("bigint").alias("invalid_records"))
    p = tm.pipeline_runs.withColumn("recorded", F.lit(True))
    runs = ds.select("run_id").distinct().unionByName(p.select("run_id")).distinct()
    j = runs.join(p, "run_id", "left").join(aff, "run_id", "left").join(bad_tests, "run_id", "left")
    n_failed = F.coalesce("affected_datasets", F.lit(0))
    pstatus = F.when(F.col("recorded"), normalize_status("status")) \
        .otherwise(F.when(n_failed > 0, "failed").otherwise("success"))
    return j.select(
        "run_id", "started_at", "finished_at", "duration_seconds",
        trigger_type("run_id").alias("trigger_type"),
        pstatus.alias("status"), "error_message",
        n_failed.cast("bigint").alias("affected_datasets"),
        F.coalesce("failed_tests", F.lit(0)).cast("bigint").alias("failed_tests"),
        F.coalesce("invalid_records", F.lit(0)).cast("bigint").alias("invalid_records"),
        F.when(n_failed > 0, "dataset")
        .when(F.coalesce("failed_tests", F.lit(0)) > 0, "quality")
        .when(pstatus == "failed", "orchestration").alias("failure_scope"),
    )


# The display labels of the run panel.
LABEL_QUALITY_FAILED = "Falha de qualidade"
LABEL_QUALITY_WARNING = "Processado com aviso"
LABEL_NOT_PROCESSED = "Não processada"
LABEL_PROCESSED = "Processado"


def dataset_labels(tm: Telemetry) -> DataFrame:
    """K-15: displayed status and label of each dataset of a run."""
    ds = run_datasets(tm).withColumn("dataset_name", F.lower(last_dotted("dataset")))
    detail = run_detail(tm).select("run_id", F.col("status").alias("run_status"),
                                   "failure_scope")
    ts = normalize_status("status")
    bad = _run_tests(tm).where(ts.isin("failed", "warning")).select("run_id", "status",
                                                                   "depends_on")
    rel = bad.join(dependency_index(tm).withColumnRenamed("dataset", "dataset_name"), "depends_on")
    flags = rel.groupBy("run_id", "dataset_name").agg(
        F.bool_or(F.lower("status").isin("error", "fail", "failed", "runtime error"))
        .alias("rel_failed"),
        F.bool_or(F.lower("status").isin("warn", "warning")).alias("rel_warning"))
    j = ds.join(flags, ["run_id", "dataset_name"], "left").join(detail, "run_id", "left")
    rf = F.coalesce("rel_failed", F.lit(False))
    rw = F.coalesce("rel_warning", F.lit(False))
    st = F.col("status")
    return j.select(
        "run_id", "dataset",
        F.when(rf, "failed").when(rw, "warning")
        .when(st.isin("failed", "blocked", "not_started"), "not_started")
        .otherwise(st).alias("display_status"),
        F.when(rf, LABEL_QUALITY_FAILED).when(rw, LABEL_QUALITY_WARNING)
        .when(st.isin("failed", "blocked", "not_started"), LABEL_NOT_PROCESSED)
        .when((F.col("run_status") == "failed") & (F.col("failure_scope") == "orchestration")
              & (st == "success"), LABEL_PROCESSED).alias("label"),
    )


def dataset_history(tm: Telemetry, dataset: str, limit: int = 50) -> DataFrame:
    """K-8 / P-19: load history of a dataset named either ``schema.table`` or
    ``schema_table``, newest first."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be within 1..200")
    i = tm.ingestion_runs
    match = (F.replace("source_table", F.lit("."), F.lit("_")) == dataset) | \
        (F.col("source_table") == dataset)
    return i.where(match).select(
        "run_id", "started_at", "finished_at", "source_row_count", "raw_row_count",
        "minio_object", "file_size_bytes", "duration_seconds", "status", "error_message",
    ).orderBy(F.col("started_at").desc()).limit(limit)


def search_datasets(rows: DataFrame, text: str = "", status: str | None = None) -> DataFrame:
    """K-14: dataset name contains ``text`` (case-insensitive) and status equals."""
    out = rows.where(F.lower("dataset").contains(text.lower()))
    return out if status in (None, "all") else out.where(F.col("status") == status)


def quality_evidence(failures: DataFrame, invocation_id: str, test_id: str, limit: int = 100
                     ) -> DataFrame:
    """K-12: stored failing rows of one test, newest first."""
    return failures.where((F.col("invocation_id") == invocation_id)
                          & (F.col("test_id") == test_id)) \
        .select("captured_at", "failure_record") \
        .orderBy(F.col("captured_at").desc(), "failure_record").limit(limit)


def platform_status(tm: Telemetry, pipeline_runs: DataFrame | None = None) -> DataFrame:
    """K-1: one-row platform status of the latest pipeline run.

    Without a pipeline row the newest orchestrated test run and the newest load
    stand in, each for its own part, and the duration is their sum; a pipeline
    that still runs has duration 0.  Freshness is that of the run's newest
    invocation (A-9).  Every "latest" pick is a ``max_by`` over its table, one row
    also where the table is empty, and every part is one row."""
    p = tm.pipeline_runs if pipeline_runs is None else pipeline_runs
    target = p.agg(F.max_by(
        F.struct("run_id", "status", "duration_seconds"),
        F.struct("started_at", "run_id")).alias("t")).select(
        F.col("t.run_id").alias("t_run"), F.col("t.status").alias("t_status"),
        F.col("t.duration_seconds").alias("t_duration"), F.col("t").isNotNull().alias("t_found"))
    run_of = F.broadcast(target.select("t_run"))                            # one row
    # A-7: the target run, or the newest load
    started = tm.ingestion_runs.groupBy("run_id").agg(F.max("started_at").alias("at"))
    ing = ingestion_rollup(tm).join(started, "run_id").crossJoin(run_of).where(
        F.col("t_run").isNull() | (F.col("run_id") == F.col("t_run"))).agg(F.max_by(F.struct(
            F.col("run_id").alias("i_run"), F.col("successful").alias("i_ok"),
            F.col("source_complete").alias("i_src"), F.col("minio_complete").alias("i_minio"),
            F.col("raw_complete").alias("i_raw"), F.col("duration_seconds").alias("i_duration")),
            F.struct("at", "run_id")).alias("i")).select("i.*")
    # A-8: the target run, or the newest orchestrated one
    runs = tm.dbt_runs.where(F.col("orchestrator_run_id").isNotNull())
    newest = runs.agg(F.max_by("orchestrator_run_id", F.struct("collected_at", "invocation_id"))
                      .alias("d_newest"))
    dbt = runs.crossJoin(run_of).crossJoin(F.broadcast(newest)).where(
        F.col("orchestrator_run_id") == F.coalesce("t_run", "d_newest")).agg(
        F.max("orchestrator_run_id").alias("d_run"),
        F.when(F.count(F.lit(1)) == 0, F.lit(None))
        .when(F.bool_or(F.col("status").isin("error", "failed")), "error")
        .when(F.bool_or(F.col("status").isin("warn", "warning")), "warn")
        .otherwise("success").alias("d_status"),
        F.sum("elapsed_seconds").alias("d_elapsed"),
        F.coalesce(F.sum("test_nodes"), F.lit(0)).cast("bigint").alias("tests_total"),
        F.coalesce(F.sum("failed_tests"), F.lit(0)).cast("bigint").alias("d_failed"),
    )
    # A-9: filtered aggregates over the results of the run's newest invocation
    checks = tm.freshness_results.crossJoin(run_of).where(
        F.col("t_run").isNull() | (F.col("orchestrator_run_id") == F.col("t_run")))
    per_invocation = checks.groupBy("invocation_id").agg(
        F.max("collected_at").alias("at"),
        F.max(F.when(F.col("freshness_type") == "technical", F.col("age_seconds")))
        .alias("technical_freshness_seconds"),
        F.max(F.when(F.col("freshness_type") == "business", F.col("max_loaded_at")))
        .alias("last_business_event_at"),
    )
    fr = per_invocation.agg(F.max_by(
        F.struct("technical_freshness_seconds", "last_business_event_at"),
        F.struct("at", "invocation_id")).alias("f")).select("f.*")
    last_ok = p.where((F.col("status") == "success") & F.col("finished_at").isNotNull()) \
        .agg(F.max("finished_at").alias("last_successful_run"))
    # node statuses per layer of the target run
    nodes = tm.run_nodes.where(F.col("layer").isNotNull()) \
        .select("orchestrator_run_id", "node_unique_id", "layer")
    nr = tm.node_results.join(run_of, F.col("orchestrator_run_id") == F.col("t_run")) \
        .join(nodes, ["orchestrator_run_id", "node_unique_id"])
    per_layer = nr.groupBy("layer").agg(*aggregate_status(F.col("status"))) \
        .select("layer", aggregate_status_value().alias("v"))
    layers = per_layer.groupBy().pivot("layer", LAYERS).agg(F.first("v"))
    # impacted datasets: any failed model stage of the target run (L-2)
    st = dataset_stage_status(tm).join(run_of, F.col("run_id") == F.col("t_run"))
    impacted = st.agg(F.count_if(F.array_contains(
        F.array("staging", "intermediate", "analytics", "powerbi"), "failed"))
        .cast("bigint").alias("datasets_impacted"))
    row = (target.crossJoin(ing).crossJoin(dbt).crossJoin(fr).crossJoin(last_ok)
           .crossJoin(layers).crossJoin(impacted))
    ing_status = F.when(F.col("i_run").isNull(), "not_started") \
        .when(F.col("i_ok"), "success").otherwise("failed")
    source = F.when(F.col("i_src"), ing_status) \
        .when(ing_status == "failed", "failed").otherwise("not_started")
    minio = F.when(F.col("i_minio"), ing_status) \
        .when(source == "failed", "blocked").otherwise("not_started")
    raw = F.when(F.col("i_raw"), ing_status) \
        .when(minio.isin("failed", "blocked"), "blocked").otherwise("not_started")
    prev = raw
    stages = {"source": source, "minio": minio, "raw": raw}
    for layer in LAYERS:
        v = F.coalesce(F.col(layer), F.lit("not_started"))
        v = F.when((v == "not_started") & prev.isin("failed", "blocked"), "blocked").otherwise(v)
        stages[layer] = v
        prev = v
    stages["tests"] = normalize_status("d_status")
    stages["powerbi"] = F.lit("unmonitored")
    critical = [stages[k] for k in stages if k != "powerbi"]
    pstatus = normalize_status("t_status")
    any_of = lambda words: reduce(lambda a, b: a | b, [c.isin(*words) for c in critical])  # noqa
    all_of = lambda words: reduce(lambda a, b: a & b, [c.isin(*words) for c in critical])  # noqa
    overall = (F.when((pstatus == "failed") | any_of(["failed"]), "failed")
               .when((pstatus == "running") | any_of(["running"]), "running")
               .when(any_of(["warning", "blocked"]), "warning")
               .when(all_of(["success", "not_applicable"]), "success")
               .otherwise("not_started"))
    out = row.select(
        overall.alias("platform_status"),
        F.coalesce("t_run", "d_run", "i_run").alias("run_id"),
        trigger_type(F.coalesce("t_run", "d_run", "i_run")).alias("trigger_type"),
        "last_successful_run",
        F.when(F.col("t_found"), F.coalesce(F.col("t_duration").cast("double"), F.lit(0.0)))
        .otherwise(F.coalesce(F.col("i_duration").cast("double"), F.lit(0.0))
                   + F.coalesce(F.col("d_elapsed").cast("double"), F.lit(0.0)))
        .alias("pipeline_duration_seconds"),
        F.col("technical_freshness_seconds").cast("double").alias("technical_freshness_seconds"),
        "last_business_event_at",
        (F.col("tests_total") - F.col("d_failed")).alias("tests_passed"),
        "tests_total",
        F.when(overall == "failed", 1).otherwise(0).alias("failed_pipelines"),
        "datasets_impacted",
        *[v.alias(f"stage_{k}") for k, v in stages.items()],
    )
    return out


def latest_run_summary(status: DataFrame) -> DataFrame:
    """K-2: the platform status as run id, status and a stage → status map."""
    keys = ["source", "minio", "raw", "staging", "intermediate", "analytics", "tests",
            "powerbi"]
    return status.select(
        "run_id", F.lit("sales_star_pipeline").alias("pipeline"),
        F.col("platform_status").alias("status"),
        F.create_map(*[x for k in keys for x in (F.lit(k), F.col(f"stage_{k}"))])
        .alias("stages"),
    )
