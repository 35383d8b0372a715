"""Ingestion snapshots, keyed upsert, artifact flattening (hand-made inputs)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from starwright.operators.upsert import read_table, upsert, upsert_table
from starwright.sources import artifacts as A
from starwright.sources import snapshot as S

LOADED = dt.datetime(2026, 8, 13, 22, 30)


def test_object_name_partitions_by_table_and_date():
    assert S.object_name(LOADED, "salesorderheader") == (
        "raw/sales_order_header/load_date=2026-08-13/sales_order_header.parquet")
    assert S.object_name(LOADED, "customer") == "raw/customer/load_date=2026-08-13/customer.parquet"


def test_snapshot_adds_load_columns_and_counts(spark, tmp_dir):
    src = spark.createDataFrame([(1, "Ada")], "customerid int, name string")
    row = S.load_table(spark, src, "sales", "customer", tmp_dir, "run-1", LOADED)
    snap = spark.read.parquet(S.snapshot_path(tmp_dir, "customer", LOADED, "run-1"))
    assert snap.columns == ["customerid", "name", "_loaded_at", "_source_table"]
    assert [tuple(r) [:2] for r in snap.collect()] == [(1, "Ada")]
    assert snap.first()["_source_table"] == "sales.customer"
    assert row["source_row_count"] == 1 and row["raw_row_count"] == 1
    assert row["file_size_bytes"] > 0 and row["status"] == "success"
    raw = read_table(spark, f"{tmp_dir}/warehouse/raw/customer")
    assert raw.count() == 1


def test_load_sources_stops_at_first_failure(spark, tmp_dir):
    ok = spark.createDataFrame([(1,)], "customerid int")
    bad = spark.createDataFrame([("x",)], "v string").select(F.col("v").cast("int").alias("v"))
    never = spark.createDataFrame([(1,)], "productid int")
    rows, err = S.load_sources(spark, {"customer": ok, "salesterritory": bad, "product": never},
                               tmp_dir, "run-2", LOADED)
    assert err is not None
    assert [(r["source_table"], r["status"]) for r in rows] == [
        ("sales.customer", "success"), ("sales.salesterritory", "failed")]
    df = S.ingestion_rows_df(spark, rows)
    assert df.count() == 2


def test_upsert_partial_columns_and_insert(spark):
    target = spark.createDataFrame(
        [("r1", "sales.customer", 10, "success", None), ("r1", "sales.store", 5, "success", None)],
        "run_id string, source_table string, source_row_count int, status string, "
        "error_message string")
    updates = spark.createDataFrame(
        [("r1", "sales.store", 99, "failed", "boom"), ("r2", "sales.customer", 7, "failed", "x")],
        "run_id string, source_table string, source_row_count int, status string, "
        "error_message string")
    out = {(r.run_id, r.source_table): r for r in upsert(
        target, updates, ["run_id", "source_table"], columns=["status", "error_message"]).collect()}
    assert out[("r1", "sales.store")].source_row_count == 5        # not listed: kept
    assert out[("r1", "sales.store")].status == "failed"
    assert out[("r1", "sales.customer")].status == "success"
    assert out[("r2", "sales.customer")].source_row_count == 7     # inserted


def test_upsert_table_versions_and_idempotence(spark, tmp_dir):
    path = os.path.join(tmp_dir, "failure_details")
    rec = spark.createDataFrame([("inv", "t1", "a"), ("inv", "t2", "b")],
                                "invocation_id string, test_id string, record string")
    upsert_table(spark, path, rec, ["invocation_id", "test_id"])
    again = spark.createDataFrame([("inv", "t1", "a2")],
                                  "invocation_id string, test_id string, record string")
    upsert_table(spark, path, again, ["invocation_id", "test_id"])
    upsert_table(spark, path, again, ["invocation_id", "test_id"])
    got = sorted((r.test_id, r.record) for r in read_table(spark, path).collect())
    assert got == [("t1", "a2"), ("t2", "b")]
    empty = read_table(spark, os.path.join(tmp_dir, "absent"), "a int")
    assert empty.count() == 0


MANIFEST = {
    "nodes": {
        "model.p.stg_customer": {"name": "stg_customer", "resource_type": "model",
                                 "original_file_path": "models\\staging\\stg_customer.sql",
                                 "depends_on": {"nodes": ["source.p.raw.customer"]},
                                 "group": "sales"},
        "model.p.dim_customer": {"name": "dim_customer", "resource_type": "model",
                                 "original_file_path": "models/analytics/dim_customer.sql",
                                 "depends_on": {"nodes": ["model.p.stg_customer"]}},
        "test.p.not_null_x": {"name": "not_null_x", "resource_type": "test",
                              "test_metadata": {"name": "not_null"},
                              "config": {"severity": "warn", "meta": {}},
                              "depends_on": {"nodes": ["model.p.dim_customer",
                                                       "model.p.stg_customer"]}},
        "test.p.assert_y": {"name": "assert_y", "resource_type": "test",
                            "config": {"meta": {"owner_email": "o@x", "owner_name": "O"}},
                            "depends_on": {"nodes": []}},
    },
    "sources": {"source.p.raw.customer": {"name": "customer", "resource_type": "source",
                                          "meta": {"freshness_type": "business"}}},
    "groups": {"group.p.sales": {"name": "sales", "owner": {"name": "Sales", "email": "s@x"}}},
}
RUN_RESULTS = {
    "metadata": {"invocation_id": "inv-1", "generated_at": "2026-08-14T00:00:00Z",
                 "dbt_version": "1.8"},
    "args": {"which": "build"}, "elapsed_time": 12.5,
    "results": [
        {"unique_id": "model.p.stg_customer", "status": "success", "execution_time": 1.0},
        {"unique_id": "model.p.dim_customer", "status": "error", "execution_time": 2.0},
        {"unique_id": "test.p.not_null_x", "status": "warn", "failures": "3"},
        {"unique_id": "test.p.assert_y", "status": "fail", "failures": True},
    ],
}
SOURCES = {
    "metadata": {"invocation_id": "fr-1"}, "elapsed_time": 1.0,
    "results": [
        {"unique_id": "source.p.raw.customer", "status": "warn", "max_loaded_at_time_ago_in_s": 100000},
        {"unique_id": "short.id", "status": "pass"},
    ],
}


@pytest.fixture()
def artifacts(spark, tmp_dir):
    paths = {}
    for name, doc in [("manifest", MANIFEST), ("run_results", RUN_RESULTS), ("sources", SOURCES)]:
        p = os.path.join(tmp_dir, f"{name}.json")
        with open(p, "w") as f:
            json.dump(doc, f)
        paths[name] = p
    m = A.read_artifact(spark, paths["manifest"], A.MANIFEST_SCHEMA)
    r = A.read_artifact(spark, paths["run_results"], A.RUN_RESULTS_SCHEMA)
    s = A.read_artifact(spark, paths["sources"], A.SOURCES_SCHEMA)
    return m, r, s, tmp_dir


def test_missing_artifact(spark, tmp_dir):
    with pytest.raises(A.MissingArtifact):
        A.read_artifact(spark, os.path.join(tmp_dir, "nope.json"), A.RUN_RESULTS_SCHEMA)
    assert A.read_artifact(spark, os.path.join(tmp_dir, "nope.json"), A.RUN_RESULTS_SCHEMA,
                           allow_missing=True) is None


def test_manifest_nodes_and_node_results(artifacts):
    m, r, _, _ = artifacts
    nodes = {x.node_unique_id: x for x in A.manifest_nodes(m, "run-1").collect()}
    assert set(nodes) == {"model.p.stg_customer", "model.p.dim_customer", "source.p.raw.customer"}
    assert nodes["model.p.stg_customer"].layer == "staging"
    assert A.manifest_nodes(m, None).count() == 0
    res = {x.node_unique_id: x.status for x in A.node_results(r, m).collect()}
    assert res == {"model.p.stg_customer": "success", "model.p.dim_customer": "error"}


def test_run_row_and_tests(artifacts):
    m, r, _, _ = artifacts
    run = A.run_row(r, m, "run-1").first()
    assert (run.status, run.total_nodes, run.test_nodes, run.failed_tests) == ("error", 4, 2, 1)
    tests = {x.test_unique_id: x for x in A.test_results(r, m).collect()}
    nn = tests["test.p.not_null_x"]
    assert (nn.test_type, nn.severity, nn.failures) == ("generic", "warn", 3)
    assert (nn.owner_group, nn.owner_email) == ("sales", "s@x")   # first dependency with a group
    ay = tests["test.p.assert_y"]
    assert (ay.test_type, ay.failures, ay.owner_email) == ("singular", None, "o@x")


def test_freshness_artifact(artifacts):
    m, _, s, _ = artifacts
    run, rows = A.freshness_results(s, m)
    got = {x.source_unique_id: x for x in rows.collect()}
    assert got["source.p.raw.customer"].table_name == "customer"
    assert got["source.p.raw.customer"].freshness_type == "business"
    assert got["short.id"].table_name is None
    r = run.first()
    assert (r.status, r.total_sources, r.warned_sources) == ("warn", 2, 1)


def test_pipeline_run_lifecycle_and_freshness(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pipeline_runs")
    start = dt.datetime(2026, 8, 14, 1, 0)
    end = dt.datetime(2026, 8, 14, 1, 10)
    upsert_table(spark, path, S.pipeline_run_row(spark, "r1", "running", started_at=start),
                 ["run_id"])
    # the finish event sets only its own columns; started_at is kept
    upsert_table(spark, path, S.pipeline_run_row(spark, "r1", "success", finished_at=end)
                 .drop("started_at", "duration_seconds"),
                 ["run_id"], columns=["finished_at", "status", "error_message"])
    r = read_table(spark, path).first()
    assert (r.status, r.started_at, r.finished_at) == ("success", start, end)

    ing = S.ingestion_rows_df(spark, [
        dict(run_id="r1", source_table="sales.customer", started_at=start, finished_at=end,
             minio_uploaded_at=end, status="success"),
        dict(run_id="r1", source_table="sales.store", started_at=start, status="failed",
             error_message="x" * 5000),
        dict(run_id="r0", source_table="sales.customer", started_at=start, finished_at=end,
             minio_uploaded_at=end, status="success")])
    assert max(len(x.error_message or "") for x in ing.collect()) == S.ERROR_MESSAGE_LIMIT
    fr = S.mark_analytics_updated(S.dataset_freshness_rows(ing), "r1", end)
    got = {(x.run_id, x.dataset_name): x for x in fr.collect()}
    assert set(got) == {("r1", "sales.customer"), ("r0", "sales.customer")}
    assert got[("r1", "sales.customer")].analytics_updated_at == end
    assert got[("r0", "sales.customer")].analytics_updated_at is None
    assert got[("r1", "sales.customer")].sla_minutes == 1440


def test_writer_that_dies_before_publishing_keeps_the_table(spark, tmp_dir, monkeypatch):
    from starwright.operators import upsert as U

    path = f"{tmp_dir}/durable"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    for i in (1, 2):
        U.upsert_table(spark, path, rows(i), ["id"])
    monkeypatch.setattr(U, "_pointer_name", lambda n: (_ for _ in ()).throw(OSError("died")))
    try:
        U.write_version(rows(9), path)
    except OSError:
        pass
    monkeypatch.undo()
    U.upsert_table(spark, path, rows(3), ["id"])
    assert sorted(r.id for r in U.read_table(spark, path).collect()) == [1, 2, 3]


def test_closure_is_deep_and_survives_cycles(spark):
    from starwright.operators.closure import descendants

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "parent string, child string")
    roots = spark.createDataFrame([("a",)], "root string")
    assert sorted(r.node for r in descendants(edges, roots).collect()) == ["a", "b", "c"]
