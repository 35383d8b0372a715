"""Run telemetry tables (the observability mart) and the model graph.

The reference records pipeline runs, ingestion runs, model/test results and a
manifest graph.  The driver's ``events`` table stands in for that history
(FIXTURES.md): one calendar day of events is one pipeline run, ``user_id % 10``
picks the dataset, ``event_type`` gives the raw status
(error→failed, purchase→success, signup→warn, view→running, click→skipped) and
``value`` the duration.  Each event is appended to the logs of the run tables
(a load attempt, a test or model result, a start or an end of the pipeline) and
the tables are those logs folded by key (``operators/runlog.py``); the owner of a
table's tests is the supplier of its group with the highest balance.  The
manifest graph is the engine's own model registry (metadata, a few dozen nodes).
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.functions.columns import layer_of, normalize_status
from starwright.operators.runlog import SEQ, WRITTEN, fold, writes
from starwright.session import checkpoint_dir
from starwright.sources.tables import Tables

PROJECT = "sales_star"

# The ten source tables in ingestion order, and the object names
# that differ from the table names in the snapshot layout.
SOURCE_TABLES = [
    ("sales", "salesorderheader"), ("sales", "salesorderdetail"), ("sales", "customer"),
    ("sales", "salesterritory"), ("sales", "store"), ("sales", "specialoffer"),
    ("sales", "salesperson"), ("production", "product"), ("person", "person"),
    ("humanresources", "employee"),
]
OBJECT_TABLE_NAMES = {
    "salesorderheader": "sales_order_header", "salesorderdetail": "sales_order_detail",
    "salesterritory": "sales_territory", "specialoffer": "special_offer",
    "salesperson": "sales_person",
}
EVENT_STATUS = [("error", "failed"), ("purchase", "success"), ("signup", "warn"),
                ("view", "running"), ("click", "skipped")]
# the analytics model whose values a source table's accepted-values tests also read
ACCEPTED_MODELS = {
    "salesorderheader": "fact_sales", "salesorderdetail": "fact_sales",
    "customer": "dim_customer", "salesterritory": "dim_sales_territory", "store": "dim_customer",
    "specialoffer": "dim_special_offer", "salesperson": "dim_sales_person",
    "product": "dim_product", "person": "dim_customer", "employee": "dim_sales_person",
}
TEST_KINDS = ["not_null", "unique", "relationships", "accepted_values"]
# durations are summed exactly (a double sum depends on the summation order)
SECONDS = "decimal(38,3)"

# model → upstream refs (the engine's model graph)
MODEL_DEPS = {
    **{f"stg_{t}": [f"source:{t}"] for _, t in SOURCE_TABLES},
    "int_sales_order_items": ["stg_salesorderheader", "stg_salesorderdetail"],
    "dim_customer": ["stg_customer", "stg_person", "stg_store"],
    "dim_date": ["stg_salesorderheader"],
    "dim_product": ["stg_product"],
    "dim_sales_person": ["stg_salesperson", "stg_employee", "stg_person"],
    "dim_sales_territory": ["stg_salesterritory"],
    "dim_special_offer": ["stg_specialoffer"],
    "fact_sales": ["int_sales_order_items"],
    "fact_sales_monthly": ["fact_sales", "dim_date"],
    "mart_sales_details": ["fact_sales", "dim_product", "dim_customer", "dim_sales_person",
                           "dim_sales_territory", "dim_special_offer"],
}
MODEL_NODES = sorted(MODEL_DEPS)  # 20 models
# the graph that runs started by hand try out: the fact reads the order views, the
# customer has no store, the sales person no person, the mart no special offer
TRIAL_DEPS = {
    **MODEL_DEPS,
    "fact_sales": ["stg_salesorderheader", "stg_salesorderdetail"],
    "dim_customer": ["stg_customer", "stg_person"],
    "dim_sales_person": ["stg_salesperson", "stg_employee"],
    "mart_sales_details": ["fact_sales", "dim_product", "dim_customer", "dim_sales_person",
                           "dim_sales_territory"],
}


def node_id(ref: str) -> str:
    if ref.startswith("source:"):
        return f"source.{PROJECT}.raw.{ref[len('source:'):]}"
    return f"model.{PROJECT}.{ref}"


def model_path(name: str) -> str:
    layer = ("staging" if name.startswith("stg_") else
             "intermediate" if name.startswith("int_") else "analytics")
    return f"models/{layer}/{name}.sql"


def manifest_rows(deps: dict[str, list[str]] = MODEL_DEPS) -> list[tuple]:
    """(node_unique_id, node_name, resource_type, original_file_path, depends_on)."""
    rows = [(node_id(f"source:{t}"), t, "source", "models/sources.yml", [])
            for _, t in SOURCE_TABLES]
    rows += [(node_id(m), m, "model", model_path(m), [node_id(d) for d in deps[m]])
             for m in sorted(deps)]
    return rows


def manifest_nodes(spark: SparkSession, deps: dict[str, list[str]] = MODEL_DEPS) -> DataFrame:
    """B-6: sources and models with layer (from the file path) and dependencies."""
    df = spark.createDataFrame(
        manifest_rows(deps),
        "node_unique_id string, node_name string, resource_type string, "
        "original_file_path string, depends_on array<string>",
    )
    return df.select("node_unique_id", "node_name", "resource_type",
                     layer_of("original_file_path").alias("layer"), "depends_on")


def run_nodes(runs: DataFrame) -> DataFrame:
    """B-6 as stored, the nodes of each run's own manifest: runs started by hand try
    out the graph of ``TRIAL_DEPS``, the others run the engine's."""
    spark = runs.sparkSession
    graphs = (manifest_nodes(spark).withColumn("__trial", F.lit(False))
              .unionByName(manifest_nodes(spark, TRIAL_DEPS).withColumn("__trial", F.lit(True))))
    runs = runs.select(F.col("run_id").alias("orchestrator_run_id")).distinct()
    # two manifests of 30 nodes
    return (runs.withColumn("__trial", F.col("orchestrator_run_id").startswith("manual__"))
            .join(F.broadcast(graphs), "__trial").drop("__trial"))


# --------------------------------------------------------------- events
def _lookup(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def event_facts(t: Tables) -> DataFrame:
    """One row per event with the derived telemetry attributes."""
    ev = t.events("event_id", "ts", "user_id", "event_type", "value", "props")
    status = None
    for raw, word in EVENT_STATUS:
        cond = F.col("event_type") == raw
        status = F.when(cond, word) if status is None else status.when(cond, word)
    day = F.date_format("ts", "yyyy-MM-dd")
    ds = F.col("user_id") % 10
    table = _lookup(ds, [tb for _, tb in SOURCE_TABLES])
    schema = _lookup(ds, [s for s, _ in SOURCE_TABLES])
    kind = _lookup((F.col("user_id") / 10).cast("bigint") % 4, TEST_KINDS)
    return ev.select(
        "event_id", "ts", "value", "props",
        F.concat(F.when(F.dayofmonth("ts") % 7 == 0, "manual__").otherwise("scheduled__"), day)
        .alias("run_id"),
        F.concat(F.lit("inv-"), F.date_format("ts", "yyyyMMdd")).alias("invocation_id"),
        F.concat(schema, F.lit("."), table).alias("source_table"),
        table.alias("table_name"),
        status.otherwise("not_started").alias("status"),
        F.concat(kind, F.lit("_stg_"), table, F.lit("_c"),
                 ((F.col("user_id") / 10).cast("bigint") % 5).cast("string")).alias("test_name"),
        _lookup(F.col("event_id") % len(MODEL_NODES), MODEL_NODES).alias("model_name"),
    )


FINISH = ["finished_at", "duration_seconds", "status", "error_message"]


def _seq() -> Column:
    return F.struct("ts", "event_id").alias(SEQ)


def _seconds(c: str) -> Column:
    return F.col(c).cast("decimal(18,3)").cast(SECONDS)


def table_owners(t: Tables) -> DataFrame:
    """The group, name and e-mail that own a source table: ten rows, each the
    supplier of the highest balance among those dealt to the table by key."""
    best = t.supplier("s_suppkey", "s_name", "s_acctbal").groupBy(
        (F.col("s_suppkey") % 10).alias("i")).agg(
        F.max_by("s_name", F.struct("s_acctbal", "s_suppkey")).alias("owner_name"))
    return best.select(
        _lookup(F.col("i"), [tb for _, tb in SOURCE_TABLES]).alias("table_name"),
        _lookup(F.col("i"), [s for s, _ in SOURCE_TABLES]).alias("owner_group"),
        "owner_name",
        F.concat(F.lower(F.replace("owner_name", F.lit("#"), F.lit("."))),
                 F.lit("@example.com")).alias("owner_email"))


def test_log(ev: DataFrame) -> DataFrame:
    """One log row per test result; a result writes all of its columns."""
    failing = F.col("status").isin("failed", "warn")
    failures = F.when(failing, F.floor("value").cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    staging = F.concat(F.lit(f"model.{PROJECT}.stg_"), F.col("table_name"))
    read = F.element_at(F.create_map(*[F.lit(x) for kv in ACCEPTED_MODELS.items() for x in kv]),
                        F.col("table_name"))
    rows = ev.select(
        "invocation_id",
        F.concat(F.lit(f"test.{PROJECT}."), F.col("test_name")).alias("test_unique_id"),
        _seq(),
        F.col("run_id").alias("orchestrator_run_id"),
        "test_name", "table_name",
        F.lit("generic").alias("test_type"),
        F.when(F.col("status") == "warn", "warn").otherwise("error").alias("severity"),
        "status",
        failures.alias("failures"),
        F.col("value").alias("execution_seconds"),
        F.when(failing, F.concat(F.lit("Got "), failures.cast("string"), F.lit(" results")))
        .alias("message"),
        F.when(F.col("test_name").startswith("accepted_values"),
               F.array(staging, F.concat(F.lit(f"model.{PROJECT}."), read)))
        .otherwise(F.array(staging)).alias("depends_on"),
        F.col("ts").alias("collected_at"),
    )
    return rows.withColumn(WRITTEN, writes(*rows.columns[3:]))


def test_results(log: DataFrame, owners: DataFrame) -> DataFrame:
    """B-9 / B-10: one row per (invocation, test), the last one written, with the
    owner of the table that the test reads."""
    return fold(log, ["invocation_id", "test_unique_id"]).join(
        owners, "table_name", "left").drop("table_name")


def node_log(ev: DataFrame) -> DataFrame:
    """One log row per model result (the model picked by ``event_id``)."""
    rows = ev.select(
        "invocation_id",
        F.concat(F.lit(f"model.{PROJECT}."), F.col("model_name")).alias("node_unique_id"),
        _seq(),
        F.col("run_id").alias("orchestrator_run_id"),
        "status",
        F.col("value").alias("execution_seconds"),
        F.col("ts").alias("collected_at"),
    )
    return rows.withColumn(WRITTEN, writes(*rows.columns[3:]))


def node_results(log: DataFrame) -> DataFrame:
    """B-7: one row per (invocation, model)."""
    return fold(log, ["invocation_id", "node_unique_id"])


def freshness_log(ev: DataFrame) -> DataFrame:
    """One log row per freshness check: the two order tables carry business time."""
    business = F.col("table_name").isin(*(t for _, t in SOURCE_TABLES[:2]))
    rows = ev.select(
        "invocation_id",
        F.concat(F.lit(f"source.{PROJECT}.raw."), F.col("table_name")).alias("source_unique_id"),
        _seq(),
        F.col("run_id").alias("orchestrator_run_id"),
        "table_name",
        F.when(business, "business").otherwise("technical").alias("freshness_type"),
        F.when(F.col("status") == "failed", "error").when(F.col("status") == "warn", "warn")
        .otherwise("pass").alias("status"),
        F.col("ts").alias("max_loaded_at"),
        F.expr("timestampadd(SECOND, cast(floor(value) as int), ts)").alias("snapshotted_at"),
        F.col("value").alias("age_seconds"),
        F.col("ts").alias("collected_at"),
    )
    return rows.withColumn(WRITTEN, writes(*rows.columns[3:]))


def freshness_results(log: DataFrame) -> DataFrame:
    """B-11: one row per (invocation, source)."""
    return fold(log, ["invocation_id", "source_unique_id"])


def run_status_precedence(status: Column) -> list[Column]:
    """A-17 parts: error > warn > success over a set of raw statuses."""
    s = F.lower(status)
    return [
        F.bool_or(s.isin("error", "fail", "failed", "runtime error")).alias("__any_error"),
        F.bool_or(s.isin("warn", "warning")).alias("__any_warn"),
    ]


def dbt_runs(tests: DataFrame) -> DataFrame:
    """B-8: one row per invocation."""
    g = tests.groupBy("invocation_id", "orchestrator_run_id").agg(
        F.min("collected_at").alias("generated_at"),
        F.max("collected_at").alias("collected_at"),
        F.sum(F.col("execution_seconds").cast("decimal(18,3)")).cast(SECONDS)
        .alias("elapsed_seconds"),
        F.count(F.lit(1)).cast("bigint").alias("test_nodes"),
        F.count_if(F.lower("status").isin("error", "fail", "failed", "runtime error"))
        .cast("bigint").alias("failed_tests"),
        *run_status_precedence(F.col("status")),
    )
    return g.select(
        "invocation_id", "orchestrator_run_id", "generated_at", "collected_at",
        F.when(F.col("__any_error"), "error").when(F.col("__any_warn"), "warn")
        .otherwise("success").alias("status"),
        "elapsed_seconds", "test_nodes", "failed_tests",
    )


def ingestion_log(ev: DataFrame) -> DataFrame:
    """One log row per load attempt of a table.  A success writes every column; a
    failure only how it ended (B-3), so what an earlier attempt of the run loaded
    stays."""
    ok = F.col("status") != "failed"
    obj = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in OBJECT_TABLE_NAMES.items() for x in kv]),
                     F.col("table_name")),
        F.col("table_name"))
    rows_read = (F.col("event_id") % 1000 + 1).cast("bigint")
    finished = F.expr("timestampadd(SECOND, cast(floor(value) as int), ts)")
    rows = ev.select(
        "run_id", "source_table", _seq(),
        F.when(ok, rows_read).alias("source_row_count"),
        F.when(ok, rows_read).alias("raw_row_count"),
        F.when(ok, F.concat(F.lit("raw/"), obj, F.lit("/load_date="),
                            F.date_format("ts", "yyyy-MM-dd"), F.lit("/"), obj,
                            F.lit(".parquet"))).alias("minio_object"),
        F.when(ok, F.length("props").cast("bigint")).alias("file_size_bytes"),
        F.col("ts").alias("started_at"),
        F.when(ok, finished).alias("minio_uploaded_at"),
        F.when(ok, finished).alias("raw_loaded_at"),
        finished.alias("finished_at"),
        _seconds("value").alias("duration_seconds"),
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.when(~ok, F.concat(F.lit("load failed: "), F.col("source_table"))).alias("error_message"),
    )
    return rows.withColumn(WRITTEN, F.when(F.col("status") == "failed", writes(*FINISH))
                           .otherwise(writes(*rows.columns[3:])))


def ingestion_runs(log: DataFrame) -> DataFrame:
    """B-2 / B-3: one row per (run, dataset)."""
    return fold(log, ["run_id", "source_table"], insert_only=("started_at",))


def pipeline_log(ev: DataFrame) -> DataFrame:
    """Starts and ends of the pipeline (B-5).  A start, or a restart, leaves the run
    unfinished: it writes no end, no duration and no message."""
    starts, failed = F.col("status") == "running", F.col("status") == "failed"
    ended = ev.where(F.col("status").isin("running", "success", "failed"))
    return ended.select(
        "run_id", _seq(),
        F.col("ts").alias("started_at"),
        F.when(~starts, F.expr("timestampadd(SECOND, cast(floor(value) as int), ts)"))
        .alias("finished_at"),
        F.when(~starts, F.floor("value").cast("bigint")).alias("duration_seconds"),
        "status",
        F.when(failed, "pipeline failed").alias("error_message"),
        writes(*FINISH).alias(WRITTEN),
    )


def pipeline_runs(log: DataFrame) -> DataFrame:
    """B-5: one row per run; its start is the first one recorded."""
    return fold(log, ["run_id"], insert_only=("started_at",))


def without_last_end(log: DataFrame) -> DataFrame:
    """A pipeline log whose newest run has not ended yet: only its starts are
    recorded, the first record of all counting as one."""
    newest = log.agg(F.max_by("run_id", SEQ).alias("newest"))
    first = log.groupBy("run_id").agg(F.min(SEQ).alias("first"))
    marked = log.join(first, "run_id").crossJoin(F.broadcast(newest))     # one row
    open_ = F.col("run_id") == F.col("newest")
    begun = marked.where(~open_ | (F.col("status") == "running") | (F.col(SEQ) == F.col("first")))

    def cut(c: str) -> Column:
        return F.when(~open_, F.col(c)).alias(c)

    return begun.select("run_id", SEQ, "started_at", cut("finished_at"), cut("duration_seconds"),
                        F.when(open_, "running").otherwise(F.col("status")).alias("status"),
                        cut("error_message"), WRITTEN)


def aggregate_status(status: Column) -> list[Column]:
    """L-3 as aggregate parts over raw statuses (null = no evidence)."""
    s = normalize_status(status)
    has = status.isNotNull()
    return [
        F.count(status).alias("__n"),
        F.bool_or(has & (s == "failed")).alias("__failed"),
        F.bool_or(has & (s == "running")).alias("__running"),
        F.bool_or(has & s.isin("warning", "blocked")).alias("__warning"),
        F.count_if(has & (s != "not_applicable")).alias("__applicable"),
        F.count_if(has & s.isin("not_started", "unmonitored")).alias("__idle"),
        F.count_if(has & (s == "success")).alias("__success"),
    ]


def aggregate_status_value() -> Column:
    """Combine the parts of :func:`aggregate_status` into the status word."""
    n, app = F.col("__n"), F.col("__applicable")
    return (
        F.when(F.coalesce(F.col("__failed"), F.lit(False)), "failed")
        .when(F.coalesce(F.col("__running"), F.lit(False)), "running")
        .when(F.coalesce(F.col("__warning"), F.lit(False)), "warning")
        .when((n == 0) | (app == 0) | (app == F.col("__idle")), "not_started")
        .when(F.col("__success") == app, "success")
        .otherwise("warning")
    )


class Telemetry:
    """Telemetry tables derived from ``events``, each built on first use.

    With ``table_dir`` set (as ``for_session`` does) every table is written
    once to the shared checkpoint folder and read back: the observability mart
    is a set of tables, and the read queries scan them instead of re-deriving
    them from the events."""

    def __init__(self, spark: SparkSession, sf_dir: str, table_dir: str | None = None):
        self.spark = spark
        self.tables = Tables(spark, sf_dir)
        self.table_dir = table_dir

    def persist(self, name: str, df: DataFrame) -> DataFrame:
        if not self.table_dir:
            return df
        path = f"{self.table_dir}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def events(self) -> DataFrame:
        return event_facts(self.tables)

    @cached_property
    def owners(self) -> DataFrame:
        return self.persist("owners", table_owners(self.tables))

    @cached_property
    def test_results(self) -> DataFrame:
        return self.persist("test_results", test_results(test_log(self.events), self.owners))

    @cached_property
    def node_results(self) -> DataFrame:
        return self.persist("node_results", node_results(node_log(self.events)))

    @cached_property
    def freshness_results(self) -> DataFrame:
        return self.persist("freshness_results", freshness_results(freshness_log(self.events)))

    @cached_property
    def dbt_runs(self) -> DataFrame:
        return self.persist("dbt_runs", dbt_runs(self.test_results))

    @cached_property
    def ingestion_runs(self) -> DataFrame:
        return self.persist("ingestion_runs", ingestion_runs(ingestion_log(self.events)))

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        return self.persist("pipeline_runs", pipeline_runs(pipeline_log(self.events)))

    @cached_property
    def unfinished_pipeline_runs(self) -> DataFrame:
        """The pipeline runs while the newest one still goes on."""
        return pipeline_runs(without_last_end(pipeline_log(self.events)))

    @cached_property
    def run_nodes(self) -> DataFrame:
        return self.persist("run_nodes", run_nodes(self.ingestion_runs))

    @classmethod
    def for_session(cls, spark: SparkSession, sf_dir: str) -> "Telemetry":
        """Memoised per session and folder (plans are immutable, safe to share)."""
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        if key not in _TELEMETRY:
            folder = f"{checkpoint_dir(spark)}/starwright-telemetry/{uuid.uuid4().hex}"
            _TELEMETRY[key] = cls(spark, sf_dir, folder)
        return _TELEMETRY[key]


_TELEMETRY: dict = {}
