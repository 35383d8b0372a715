"""Generic data-quality operators (Q-1 … Q-4, Q-7, Q-8).

A rule returns its *failing rows*; zero rows means pass.  Each rule has a
severity (``error`` stops later layers, ``warn`` does not).  For the run
summary the failure *counts* of every rule on a model are computed in as few
passes as possible: all ``not_null`` and ``accepted_values`` rules of a model
share one aggregate scan; ``unique`` and ``relationships`` need one keyed
aggregate / anti join each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.operators.unions import union_all


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | unique | relationships | accepted_values
    model: str
    column: str
    severity: str = "error"
    to_model: str | None = None    # relationships parent
    to_column: str | None = None
    values: tuple = field(default_factory=tuple)

    @property
    def rule_id(self) -> str:
        suffix = f"__{self.to_model}_{self.to_column}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.model}_{self.column}{suffix}"


# ------------------------------------------------------------ failing rows
def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (nulls ignored); partial aggregation
    keeps even a hot value to one row per task before the shuffle."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, to_column: str
                           ) -> DataFrame:
    """Non-null child keys with no parent row (``left_anti``; nulls pass)."""
    keys = parent.select(F.col(to_column).alias("__parent_key"))
    return (
        child.where(F.col(column).isNotNull())
        .select(F.col(column).alias("from_field"))
        .join(keys, F.col("from_field") == F.col("__parent_key"), "left_anti")
    )


def accepted_values_failures(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list, with their counts (nulls pass)."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def failing_rows(rule: Rule, models) -> DataFrame:
    df = models(rule.model)
    if rule.kind == "not_null":
        return not_null_failures(df, rule.column)
    if rule.kind == "unique":
        return unique_failures(df, rule.column)
    if rule.kind == "relationships":
        return relationships_failures(df, rule.column, models(rule.to_model), rule.to_column)
    if rule.kind == "accepted_values":
        return accepted_values_failures(df, rule.column, rule.values)
    raise ValueError(rule.kind)


# -------------------------------------------------------- batched counting
def _count_row(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.model).alias("model"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def scan_rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One aggregate pass for every not_null / accepted_values rule of a model."""
    aggs = []
    for r in rules:
        if r.kind == "not_null":
            aggs.append(_count_row(r, F.count_if(F.col(r.column).isNull())))
        elif r.kind == "accepted_values":
            # the rule returns one row per offending value
            bad = F.when(~F.col(r.column).isin(*r.values), F.col(r.column))
            aggs.append(_count_row(r, F.count_distinct(bad)))
    if not aggs:
        return None
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def keyed_rule_count(rule: Rule, models) -> DataFrame:
    """unique / relationships failure count as a one-row DataFrame."""
    # failures = number of failing rows the rule returns (duplicated values for
    # unique, orphan child rows for relationships)
    failing = failing_rows(rule, models)
    return failing.agg(_count_row(rule, F.count(F.lit(1))).alias("r")).select("r.*")


def rule_counts(rules: list[Rule], models) -> DataFrame:
    """Failure count and status of every rule, as one DataFrame."""
    parts = []
    by_model: dict[str, list[Rule]] = {}
    for r in rules:
        by_model.setdefault(r.model, []).append(r)
    for model, rs in by_model.items():
        scanned = scan_rule_counts(models(model), rs)
        if scanned is not None:
            parts.append(scanned)
        parts += [keyed_rule_count(r, models) for r in rs
                  if r.kind in ("unique", "relationships")]
    counts = union_all(parts)
    return counts.withColumn(
        "status",
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail"),
    )


# --------------------------------------------------------------- Q-8 gate
class LayerGateError(RuntimeError):
    """An ``error``-severity rule failed; later layers must not run."""


def gate(counts_rows: list) -> None:
    """Raise when any collected rule-count row failed with severity error.

    ``counts_rows`` are the (small, one row per rule) collected results of
    :func:`rule_counts` — persisted before the gate is evaluated.
    """
    failed = [r["rule_id"] for r in counts_rows if r["status"] == "fail"]
    if failed:
        raise LayerGateError(f"{len(failed)} error rule(s) failed: {failed[:10]}")
