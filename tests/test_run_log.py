"""Folded logs and the evidence store against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starwright.operators import constraints, evidence
from starwright.operators.runlog import fold

LOG = ("k long, seq struct<at:int,id:int>, written array<string>, started int, status string, "
       "rows long")


def brute_fold(rows):
    out = {}
    for k, seq, written, *values in sorted(rows, key=lambda r: r[1]):
        names = ("started", "status", "rows")
        row = out.setdefault(k, dict.fromkeys(names, None) | {"wrote": set(), "first": values[0]})
        for name, value in zip(names, values, strict=True):
            if name in written:
                row[name] = value
                row["wrote"].add(name)
    return {k: (r["started"] if "started" in r["wrote"] else r["first"], r["status"], r["rows"])
            for k, r in out.items()}


def test_fold_equals_brute_force(spark):
    r = random.Random(2)
    rows = [(r.choice([None, *range(6)]), (r.randint(0, 30), i),
             r.sample(["started", "status", "rows"], r.randint(0, 3)), r.randint(0, 9),
             r.choice([None, "running", "failed", "success"]), r.choice([None, 1, 2]))
            for i in range(150)]
    log = spark.createDataFrame(rows, LOG)
    got = {x.k: (x.started, x.status, x.rows)
           for x in fold(log, ["k"], insert_only=("started",)).collect()}
    assert got == brute_fold(rows)
    # a row appended again, and any order of the appends, changes nothing
    again = fold(log.unionAll(log).orderBy(F.rand(3)), ["k"], insert_only=("started",))
    assert {x.k: (x.started, x.status, x.rows) for x in again.collect()} == got
    assert fold(log.limit(0), ["k"]).count() == 0


def test_a_failure_keeps_what_was_loaded_and_a_success_clears_the_message(spark):
    finish, every = ["status", "message"], ["started", "status", "message", "rows"]
    log = spark.createDataFrame(
        [("a", 1, every, 1, "success", None, 10), ("a", 2, finish, 2, "failed", "boom", None),
         ("b", 1, finish, 1, "failed", "boom", None), ("b", 2, every, 2, "success", None, 7)],
        "k string, seq int, written array<string>, started int, status string, message string, "
        "rows int")
    got = {x.k: (x.started, x.status, x.message, x.rows)
           for x in fold(log, ["k"], insert_only=("started",)).collect()}
    assert got == {"a": (1, "failed", "boom", 10), "b": (2, "success", None, 7)}


def test_capturing_again_replaces_also_by_nothing(spark, tmp_dir):
    day = dt.datetime(2025, 1, 1)
    rows = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")

    def held():
        found = evidence.evidence(spark, tmp_dir).collect()
        return sorted((r.invocation_id, r.test_id, r.captured_at, r.failure_record) for r in found)

    evidence.capture(rows, "i", "t1", day, tmp_dir)
    evidence.capture(rows, "i", "t2", day, tmp_dir)
    evidence.capture(rows, "j", "t1", day, tmp_dir)
    assert len(held()) == 6 and held()[0][3] == '{"id":1,"v":null}'
    evidence.capture(rows.where("id = 2"), "i", "t1", day + dt.timedelta(1), tmp_dir)
    assert [h[:2] for h in held()].count(("i", "t1")) == 1 and len(held()) == 5
    evidence.capture(rows.where("false"), "i", "t1", day + dt.timedelta(2), tmp_dir)
    assert [h[:2] for h in held()] == [("i", "t2")] * 2 + [("j", "t1")] * 2
    # rows without a marker were never captured
    evidence.as_records(rows).select(F.lit("dead").alias("capture_id"), "failure_record") \
        .write.mode("append").parquet(f"{tmp_dir}/rows")
    assert len(held()) == 4


def test_checked_write_measures_keys_and_nulls(spark, tmp_dir):
    columns = "territory_id int, territory_name string, country_region_code string, " \
              "territory_group string, row_guid string, modified_at string, _loaded_at string, " \
              "_source_table string"
    rows = [(1, *"abcdefg"), (2, None, *"bcdefg"), (1, *"abcdefg"), (1, *"abcdefg")]
    path, broken = constraints.checked_write(
        "dim_sales_territory", spark.createDataFrame(rows, columns), tmp_dir, None)
    assert spark.read.parquet(path).count() == 4
    assert broken == [("dim_sales_territory_territory_name_not_null", 1),
                      ("dim_sales_territory_territory_id_pk", 2)]
    people = spark.createDataFrame([(1, 1), (2, 9), (3, None), (None, 9)],
                                   "sales_person_id long, territory_id int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "territory_id int")
    found = {r.constraint_name: r.violations for r in constraints.key_violations(
        "dim_sales_person", people, lambda model: parent).collect()}
    assert found == {"dim_sales_person_sales_person_id_pk": 1,
                     "dim_sales_person_territory_id_fk": 2}
