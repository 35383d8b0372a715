"""Run artifacts (S-9 … S-11) and their flattening into telemetry rows (B-6 … B-11).

The JSON artifacts are read with declared schemas: ``nodes``, ``sources`` and
``groups`` are ``map<string, struct<…>>`` (schema inference would make one
struct field per node) and are exploded into rows.  ``failures`` is declared
as text and converted leniently (``'3'`` → 3, ``true``/``'invalid'``/null →
null).  Every flattening is a DataFrame job: explode, join, aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starwright.functions.columns import last_dotted, layer_of, try_int

_NODE = (
    "struct<name:string, resource_type:string, original_file_path:string, "
    "depends_on:struct<nodes:array<string>>, "
    "config:struct<severity:string, store_failures:boolean, group:string, "
    "meta:map<string,string>>, "
    "group:string, schema:string, alias:string, relation_name:string, "
    "test_metadata:struct<name:string>, meta:map<string,string>>"
)
MANIFEST_SCHEMA = (
    f"nodes map<string,{_NODE}>, sources map<string,{_NODE}>, "
    "groups map<string,struct<name:string, owner:struct<name:string, email:string>>>"
)
RUN_RESULTS_SCHEMA = (
    "metadata struct<invocation_id:string, generated_at:string, dbt_version:string>, "
    "args struct<which:string>, elapsed_time double, "
    "results array<struct<unique_id:string, status:string, failures:string, "
    "execution_time:double, message:string>>"
)
SOURCES_SCHEMA = (
    "metadata struct<invocation_id:string, generated_at:string, dbt_version:string>, "
    "elapsed_time double, "
    "results array<struct<unique_id:string, status:string, max_loaded_at:string, "
    "snapshotted_at:string, max_loaded_at_time_ago_in_s:double, "
    "criteria:map<string,string>, execution_time:double, error:string>>"
)
FAILURE_WORDS = ["error", "fail", "failed", "runtime error"]


class MissingArtifact(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_artifact(spark: SparkSession, path: str, schema: str, allow_missing: bool = False
                  ) -> DataFrame | None:
    if not _exists(spark, path):
        if allow_missing:
            return None
        raise MissingArtifact(path)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def manifest_resources(manifest: DataFrame) -> DataFrame:
    """U-3: sources and nodes as rows; on a duplicate id the node wins."""
    nodes = manifest.select(F.explode("nodes").alias("unique_id", "n"), F.lit(1).alias("__prio"))
    sources = manifest.select(F.explode("sources").alias("unique_id", "n"),
                              F.lit(0).alias("__prio"))
    both = nodes.unionByName(sources)
    w = Window.partitionBy("unique_id").orderBy(F.col("__prio").desc())
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1") \
        .select("unique_id", "n")


def manifest_nodes(manifest: DataFrame, orchestrator_run_id: str | None) -> DataFrame:
    """B-6: source and model nodes with layer and dependencies (skipped
    without an orchestrator run id)."""
    res = manifest_resources(manifest)
    out = res.where(F.col("n.resource_type").isin("source", "model")).select(
        F.lit(orchestrator_run_id).cast("string").alias("orchestrator_run_id"),
        F.col("unique_id").alias("node_unique_id"),
        F.coalesce("n.name", "unique_id").alias("node_name"),
        F.col("n.resource_type").alias("resource_type"),
        layer_of("n.original_file_path").alias("layer"),
        F.coalesce("n.depends_on.nodes", F.array().cast("array<string>")).alias("depends_on"),
    )
    return out if orchestrator_run_id else out.limit(0)


def results(run_results: DataFrame) -> DataFrame:
    return run_results.select(
        F.col("metadata.invocation_id").alias("invocation_id"),
        F.posexplode("results").alias("pos", "r"),
    )


def node_results(run_results: DataFrame, manifest: DataFrame) -> DataFrame:
    """B-7: results of model nodes."""
    nodes = manifest.select(F.explode("nodes").alias("unique_id", "n"))
    r = results(run_results)
    j = r.join(nodes, F.col("r.unique_id") == F.col("unique_id"))
    return j.where(F.col("n.resource_type") == "model").select(
        "invocation_id",
        F.col("r.unique_id").alias("node_unique_id"),
        F.coalesce("n.name", "r.unique_id").alias("node_name"),
        F.col("n.resource_type").alias("resource_type"),
        layer_of("n.original_file_path").alias("layer"),
        F.coalesce("r.status", F.lit("unknown")).alias("status"),
        F.col("r.execution_time").alias("execution_seconds"),
        F.col("r.message").alias("message"),
    )


def test_result_rows(run_results: DataFrame, manifest: DataFrame) -> DataFrame:
    """Results whose manifest node is a test, with the node's attributes."""
    nodes = manifest.select(F.explode("nodes").alias("unique_id", "n"))
    r = results(run_results)
    return r.join(nodes, F.col("r.unique_id") == F.col("unique_id")) \
        .where(F.col("n.resource_type") == "test").drop("unique_id")


def run_row(run_results: DataFrame, manifest: DataFrame, orchestrator_run_id: str | None
            ) -> DataFrame:
    """B-8: one row per invocation: status precedence and node/test counts."""
    all_status = run_results.select(
        "metadata", "args", "elapsed_time",
        F.size("results").alias("total_nodes"),
        F.exists("results", lambda x: F.lower(x.status).isin(*FAILURE_WORDS)).alias("__err"),
        F.exists("results", lambda x: F.lower(x.status).isin("warn", "warning")).alias("__warn"),
    )
    tests = test_result_rows(run_results, manifest).agg(
        F.count(F.lit(1)).cast("bigint").alias("test_nodes"),
        F.count_if(F.lower("r.status").isin(*FAILURE_WORDS)).cast("bigint")
        .alias("failed_tests"),
    )
    return all_status.crossJoin(tests).select(
        F.col("metadata.invocation_id").alias("invocation_id"),
        F.lit(orchestrator_run_id).cast("string").alias("orchestrator_run_id"),
        F.col("metadata.generated_at").alias("generated_at"),
        F.col("metadata.dbt_version").alias("dbt_version"),
        F.col("args.which").alias("command"),
        F.when(F.col("__err"), "error").when(F.col("__warn"), "warn").otherwise("success")
        .alias("status"),
        F.col("elapsed_time").alias("elapsed_seconds"),
        F.col("total_nodes").cast("bigint").alias("total_nodes"),
        "test_nodes", "failed_tests",
    )


def test_results(run_results: DataFrame, manifest: DataFrame) -> DataFrame:
    """B-9 + B-10: test results with type, severity, lenient failures,
    dependencies and the resolved owner."""
    t = test_result_rows(run_results, manifest)
    owners = test_owners(manifest)
    base = t.select(
        "invocation_id",
        F.col("r.unique_id").alias("test_unique_id"),
        F.coalesce("n.name", "r.unique_id").alias("test_name"),
        F.when(F.col("n.test_metadata").isNotNull(), "generic").otherwise("singular")
        .alias("test_type"),
        F.coalesce("n.config.severity", F.lit("error")).alias("severity"),
        F.coalesce("r.status", F.lit("unknown")).alias("status"),
        try_int("r.failures").alias("failures"),
        F.col("r.execution_time").alias("execution_seconds"),
        F.col("r.message").alias("message"),
        F.col("n.relation_name").alias("failure_relation"),
        F.coalesce("n.depends_on.nodes", F.array().cast("array<string>")).alias("depends_on"),
    )
    return base.join(owners, "test_unique_id", "left")


def test_owners(manifest: DataFrame) -> DataFrame:
    """B-10: owner from the test's meta when it has an e-mail, else the group
    of the *first* dependency (in list order) whose group exists."""
    nodes = manifest.select(F.explode("nodes").alias("test_unique_id", "n")) \
        .where(F.col("n.resource_type") == "test")
    meta = nodes.select(
        "test_unique_id",
        F.col("n.config.meta").getItem("owner_group").alias("m_group"),
        F.coalesce(F.col("n.config.meta").getItem("owner_name"),
                   F.col("n.config.meta").getItem("owner")).alias("m_name"),
        F.col("n.config.meta").getItem("owner_email").alias("m_email"),
    )
    deps = nodes.select("test_unique_id",
                        F.posexplode(F.coalesce("n.depends_on.nodes",
                                                F.array().cast("array<string>")))
                        .alias("pos", "dep"))
    res = manifest_resources(manifest).select(
        F.col("unique_id").alias("dep"),
        F.coalesce("n.group", "n.config.group").alias("group_name"))
    groups = manifest.select(F.explode("groups").alias("k", "g")).select(
        F.col("g.name").alias("group_name"), F.col("g.owner.name").alias("g_owner"),
        F.col("g.owner.email").alias("g_email")).where(F.col("group_name").isNotNull())
    first = (deps.join(res, "dep").join(groups, "group_name")
             .groupBy("test_unique_id")
             .agg(F.min_by(F.struct("group_name", "g_owner", "g_email"), "pos").alias("o")))
    j = meta.join(first, "test_unique_id", "left")
    use_meta = F.col("m_email").isNotNull() & (F.col("m_email") != "")
    return j.select(
        "test_unique_id",
        F.when(use_meta, F.col("m_group")).otherwise(F.col("o.group_name")).alias("owner_group"),
        F.when(use_meta, F.col("m_name")).otherwise(F.col("o.g_owner")).alias("owner_name"),
        F.when(use_meta, F.col("m_email")).otherwise(F.col("o.g_email")).alias("owner_email"),
    )


def freshness_results(sources: DataFrame, manifest: DataFrame | None) -> tuple[DataFrame,
                                                                               DataFrame]:
    """B-11 / A-15 / F-30: freshness run row and one row per source result."""
    r = sources.select(F.col("metadata.invocation_id").alias("invocation_id"),
                       F.explode("results").alias("r"))
    parts = F.split("r.unique_id", r"\.")
    if manifest is not None:
        types = manifest.select(F.explode("sources").alias("uid", "n")).select(
            "uid", F.coalesce(F.col("n.meta").getItem("freshness_type"), F.lit("technical"))
            .alias("freshness_type"))
        r = r.join(types, F.col("r.unique_id") == F.col("uid"), "left")
    else:
        r = r.withColumn("freshness_type", F.lit(None).cast("string"))
    rows = r.select(
        "invocation_id",
        F.col("r.unique_id").alias("source_unique_id"),
        F.when(F.size(parts) >= 4, F.element_at(parts, -2)).alias("source_name"),
        F.when(F.size(parts) >= 4, last_dotted("r.unique_id")).alias("table_name"),
        F.coalesce("freshness_type", F.lit("technical")).alias("freshness_type"),
        F.coalesce("r.status", F.lit("unknown")).alias("status"),
        F.col("r.max_loaded_at").alias("max_loaded_at"),
        F.col("r.snapshotted_at").alias("snapshotted_at"),
        F.col("r.max_loaded_at_time_ago_in_s").alias("age_seconds"),
        F.to_json("r.criteria").alias("criteria"),
        F.col("r.execution_time").alias("execution_seconds"),
        F.col("r.error").alias("error_message"),
    )
    s = F.lower("status")
    counts = rows.groupBy("invocation_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_sources"),
        F.count_if(s == "warn").cast("bigint").alias("warned_sources"),
        F.count_if(s.isin("error", "runtime error")).cast("bigint").alias("errored_sources"),
    )
    # an artifact without results is a run as well
    run = sources.select(F.col("metadata.invocation_id").alias("invocation_id"),
                         F.col("metadata.generated_at").alias("generated_at"),
                         F.col("elapsed_time").alias("elapsed_seconds")
                         ).join(counts, "invocation_id", "left").select(
        "invocation_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
          for c in ("total_sources", "warned_sources", "errored_sources")),
        "generated_at", "elapsed_seconds")
    run = run.withColumn(
        "status",
        F.when(F.col("errored_sources") > 0, "error")
        .when(F.col("warned_sources") > 0, "warn").otherwise("success"))
    return run, rows
