"""Q-7 / Q-8: layered build with quality gates.

``run_layers`` builds staging → intermediate → analytics.  Per layer it

1. enforces the contracts of the layer's table models and writes them aside, below
   ``<out>/_staged/<layer>/<model>``, measuring their key and null constraints as
   they are written (the layer's rules and later layers read the written tables,
   so each model is computed once and lineage is cut at the layer boundary); a
   broken constraint stops the run;
2. evaluates every declared column rule and singular rule of the layer —
   column rules in batched passes (operators.quality.rule_counts);
3. stores the failing rows of rules that keep evidence, those without any as an
   empty capture (operators.evidence);
4. persists the rule results, *then* raises :class:`LayerGateError` when an
   ``error`` rule failed, so later layers never run on bad data while the
   evidence of the failed layer is kept.  ``warn`` rules never stop the run;
5. publishes the layer's tables under ``<out>/<layer>/<model>`` only then: a table
   that fails is never the current one.
"""

from __future__ import annotations


import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.unions import union_all

from starwright.operators import constraints, contracts, evidence, quality
from starwright.operators.upsert import write_version
from starwright.plans import rules
from starwright.plans.warehouse import MODEL_LAYERS, Warehouse

# table models (the rest are views: computed on read)
TABLE_MODELS = set(contracts.ENFORCED)


def singular_layer(name: str) -> str:
    _, inputs, _ = rules.SINGULAR[name]
    order = ["staging", "intermediate", "analytics"]
    return max((next(l for l in order if m in MODEL_LAYERS[l]) for m in inputs),
               key=order.index)


def run_layers(wh: Warehouse, out: str, invocation_id: str, captured_at: str,
               layers=("staging", "intermediate", "analytics")) -> DataFrame:
    spark = wh.stg("stg_customer").sparkSession
    mw = wh.model
    at = dt.datetime.fromisoformat(captured_at)
    captured = _captured(spark, f"{out}/_quality/evidence", invocation_id)
    for layer in layers:
        staged, broken = [], []
        for name in MODEL_LAYERS[layer]:
            if name in TABLE_MODELS:
                df = contracts.enforce(name, wh.model(name))
                path, faults = constraints.checked_write(
                    name, df, f"{out}/_staged/{layer}/{name}", mw)
                wh.materialized[name] = spark.read.schema(df.schema).parquet(path)
                staged.append(name)
                broken += faults
        if broken:
            raise constraints.ConstraintError(f"{layer}: {broken}")
        layer_rules = rules.rules_for_layer(MODEL_LAYERS[layer])
        counts = quality.rule_counts(layer_rules, mw) if layer_rules else None
        singular = [n for n in rules.SINGULAR if singular_layer(n) == layer]
        parts = [counts] if counts is not None else []
        for n in singular:
            failing = rules.singular_failures(n, wh)
            parts.append(failing.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
                F.lit(n).alias("rule_id"), F.lit("singular").alias("kind"),
                F.lit(",".join(rules.SINGULAR[n][1])).alias("model"),
                F.lit(None).cast("string").alias("column_name"), F.lit("error").alias("severity"),
                "failures",
                F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")))
        if not parts:
            continue
        layer_counts = union_all(parts)
        results_path = f"{out}/_quality/results/invocation_id={invocation_id}/layer={layer}"
        layer_counts.write.mode("overwrite").parquet(results_path)
        collected = spark.read.parquet(results_path).collect()  # one row per rule
        for r in collected:
            if r["kind"] == "singular" and not rules.SINGULAR[r["rule_id"]][2]:
                continue
            if r["status"] == "pass":
                if r["rule_id"] in captured:
                    evidence.capture(spark.createDataFrame([], "none string"), invocation_id,
                                     r["rule_id"], at, f"{out}/_quality/evidence")
                continue
            failing = (rules.singular_failures(r["rule_id"], wh)
                       if r["kind"] == "singular" else
                       quality.failing_rows(_rule(r["rule_id"]), mw))
            evidence.capture(failing, invocation_id, r["rule_id"], at,
                             f"{out}/_quality/evidence")
        quality.gate(collected)
        for name in staged:
            write_version(wh.materialized[name], f"{out}/{layer}/{name}")
    return spark.read.parquet(f"{out}/_quality/results")


def _captured(spark, store: str, invocation_id: str) -> set[str]:
    """The tests of an invocation that have a capture: at most one for each rule."""
    try:
        found = evidence.captures(spark, store).where(F.col("invocation_id") == invocation_id)
        return {r["test_id"] for r in found.select("test_id").collect()}
    except AnalysisException:                       # nothing was ever captured
        return set()


def _rule(rule_id: str) -> quality.Rule:
    return next(r for r in rules.catalogue() if r.rule_id == rule_id)


def main(argv: list[str] | None = None) -> int:
    """``python -m starwright.plans.pipeline <sf_dir> <out> [invocation_id] [as_of]``:
    build the layers over the driver tables with quality gates."""
    import sys

    from pyspark.sql import SparkSession

    from starwright.session import apply_core_conf
    from starwright.sources.fixtures import raw_sources
    from starwright.sources.tables import Tables

    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) < 2:
        print(main.__doc__)
        return 2
    sf_dir, out = args[0], args[1]
    invocation = args[2] if len(args) > 2 else "manual"
    as_of = dt.date.fromisoformat(args[3]) if len(args) > 3 else dt.date.today()
    spark = SparkSession.builder.getOrCreate()
    apply_core_conf(spark)
    wh = Warehouse(raw_sources(Tables(spark, sf_dir)), as_of=as_of)
    try:
        run_layers(wh, out, invocation, dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    except quality.LayerGateError as exc:
        print(f"stopped: {exc}")
        return 1
    print("all layers passed")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
