"""Hand-made rows for the paths the driver data cannot reach (FIXTURES.md part C)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starwright.operators import constraints, evidence, quality
from starwright.operators.contracts import contract_violations, enforce, ContractError
from starwright.operators.ranking import global_dense_rank, top_n_with_ties
from starwright.plans import rules
from starwright.plans.staging import MODELS, PASS_THROUGH, SOURCE_OF
from starwright.plans.star import line_amounts
from starwright.plans.warehouse import Warehouse


def raw_frame(spark, model, rows):
    cols = [r for r, _, _ in MODELS[model]] + [r for r, _, _ in PASS_THROUGH.get(model, [])]
    data = [tuple(None if row.get(c) is None else str(row.get(c)) for c in cols) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))


TS = "2024-01-01 00:00:00"
META = {"_loaded_at": "2024-04-01 00:00:00", "rowguid": "A0000000-0000-4000-8000-000000000001",
        "modifieddate": TS}


@pytest.fixture(scope="module")
def tiny(spark):
    def rows(model, items):
        src = {**{"_source_table": f"x.{SOURCE_OF[model]}"}, **META}
        return raw_frame(spark, model, [{**src, **r} for r in items])

    raw = {
        "salesorderheader": rows("stg_salesorderheader", [
            dict(salesorderid=1, orderdate="2024-01-15 00:00:00", duedate="2024-01-27 00:00:00",
                 status=5, onlineorderflag="false", customerid=1, territoryid=1,
                 subtotal="0.0001", salespersonid=7),
            dict(salesorderid=2, orderdate="2024-03-10 00:00:00", duedate="2024-03-22 00:00:00",
                 status=5, onlineorderflag="true", customerid=2, territoryid=1, subtotal="20"),
            dict(salesorderid=3, orderdate="2024-03-11 00:00:00", duedate="2024-03-23 00:00:00",
                 status=1, onlineorderflag="true", customerid=4, territoryid=1, subtotal="5"),
        ]),
        "salesorderdetail": rows("stg_salesorderdetail", [
            dict(salesorderid=1, salesorderdetailid=11, orderqty=1, productid=1, specialofferid=1,
                 unitprice="0.0001", unitpricediscount="0.4999"),
            dict(salesorderid=2, salesorderdetailid=21, orderqty=2, productid=1, specialofferid=1,
                 unitprice="10", unitpricediscount="0"),
        ]),
        "customer": rows("stg_customer", [
            dict(customerid=1, personid=10, storeid=20, territoryid=1),
            dict(customerid=2, territoryid=1),
            dict(customerid=3, storeid=21, territoryid=1),
            dict(customerid=4, personid=11, territoryid=1),
        ]),
        "person": rows("stg_person", [
            dict(businessentityid=10, persontype=" IN ", firstname="Grace", middlename="B",
                 lastname="Hopper"),
            dict(businessentityid=11, persontype="IN", firstname="Ada", lastname="Lovelace"),
            dict(businessentityid=7, persontype="SP", firstname="Sal", lastname="Person"),
        ]),
        "store": rows("stg_store", [dict(businessentityid=20, name="Bike Store"),
                                    dict(businessentityid=21, name="Other Store")]),
        "product": rows("stg_product", [dict(productid=1, name="Bolt", productnumber="B-1",
                                             makeflag="true", finishedgoodsflag="true",
                                             standardcost="1", listprice="2",
                                             sellstartdate=TS, sizeunitmeasurecode=" CM ")]),
        "salesterritory": rows("stg_salesterritory", [
            dict(territoryid=1, name="Northwest", countryregioncode="USA-long", group="North America")]),
        "specialoffer": rows("stg_specialoffer", [
            dict(specialofferid=1, description="No Discount", discountpct="0", type="No Discount",
                 category="No Discount", startdate=TS, enddate="2025-01-01 00:00:00", minqty=0)]),
        "salesperson": rows("stg_salesperson", [
            dict(businessentityid=7, territoryid=1, bonus="0", commissionpct="0.01",
                 salesytd="0", saleslastyear="0")]),
        "employee": rows("stg_employee", [
            dict(businessentityid=7, nationalidnumber="1", loginid="a", jobtitle="Sales",
                 birthdate="1980-01-01", maritalstatus="M", gender="F", hiredate="2000-01-01",
                 salariedflag="true", vacationhours=1, sickleavehours=1, currentflag="true",
                 organizationnode="/1/")]),
    }
    return Warehouse(raw, as_of=dt.date(2024, 6, 30))


def test_decimal_amounts_round_once(spark):
    # D-1: 1 × 0.0001 × 0.4999 is 0.00004999 → 0.0000 (Spark's default 38-digit
    # adjustment would round to 6 places first and give 0.0001)
    df = spark.createDataFrame([(1, Decimal("0.0001"), Decimal("0.4999"))],
                               "q smallint, p decimal(19,4), d decimal(19,4)")
    g, d, n = line_amounts(F.col("q"), F.col("p"), F.col("d"))
    r = df.select(g.alias("g"), d.alias("d"), n.alias("n")).first()
    assert (r.g, r.d, r.n) == (Decimal("0.0001"), Decimal("0.0000"), Decimal("0.0001"))


def test_staging_trims_and_truncates(tiny):
    p = tiny.stg("stg_product").first()
    assert p.size_unit_measure_code == "CM"
    t = tiny.stg("stg_salesterritory").first()
    assert t.country_region_code == "USA"           # varchar(3) truncates
    assert tiny.stg("stg_person").where("business_entity_id = 10").first().person_type == "IN"


def test_customer_types_and_names(tiny):
    rows = {r.customer_id: r for r in tiny.dim_customer.collect()}
    assert rows[1].customer_type == "Store with person"
    assert rows[2].customer_type == "Unknown" and rows[2].person_name == ""   # D-2 / D-3
    assert rows[3].customer_type == "Store"
    assert rows[4].person_name == "Ada Lovelace"                               # F-3 null skip
    mart = {r.sales_order_detail_id: r for r in tiny.mart_sales_details.collect()}
    assert mart[11].customer_name == "Bike Store"
    assert mart[21].customer_name == ""            # '' not 'Unknown' (coalesce of '')
    assert mart[11].sales_person_name == "Sal Person"


def test_unknown_customer_type_is_flagged(tiny):
    r = quality.Rule("accepted_values", "dim_customer", "customer_type",
                     values=("Person", "Store", "Store with person"))
    bad = quality.failing_rows(r, tiny.model).collect()
    assert [(b.value_field, b.n_records) for b in bad] == [("Unknown", 1)]


def test_monthly_zero_fills_missing_month(tiny):
    m = {r.sales_month: r for r in tiny.fact_sales_monthly.collect()}
    assert sorted(m) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    feb = m[dt.date(2024, 2, 1)]
    assert (feb.orders_count, feb.net_sales, feb.average_order_value) == (0, 0, 0)
    assert feb.first_order_date is None and feb.sales_days == 0
    assert feb.is_complete_month is True and m[dt.date(2024, 1, 1)].is_complete_month is False
    assert rules.monthly_missing_months(tiny.fact_sales_monthly).count() == 0
    assert rules.monthly_reconciles(tiny.fact_sales_monthly, tiny.fact_sales).count() == 0


def test_subtotals_both_sides(spark, tiny):
    failing = {r.sales_order_id: r for r in rules.order_subtotals(
        tiny.stg("stg_salesorderheader"), tiny.int_sales_order_items).collect()}
    assert set(failing) == {3}          # header without lines; 1 and 2 reconcile
    items = spark.createDataFrame([(99, Decimal("1.0000"))], "sales_order_id bigint, net_amount decimal(19,4)")
    header = spark.createDataFrame([(98, Decimal("1.0000"))], "sales_order_id bigint, subtotal decimal(19,4)")
    both = {r.sales_order_id: r for r in rules.order_subtotals(header, items).collect()}
    assert both[99].expected_subtotal is None and both[98].calculated_subtotal is None


def test_relationships_ignore_null_children(spark):
    child = spark.createDataFrame([(1,), (None,), (5,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")   # duplicate parents are fine
    assert [r.from_field for r in quality.relationships_failures(child, "k", parent, "k").collect()] == [5]


def test_unique_ignores_nulls_and_counts_groups(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert [(r.unique_field, r.n_records) for r in quality.unique_failures(df, "k").collect()] == [(1, 2)]


def test_rule_counts_and_gate(tiny):
    counts = quality.rule_counts(rules.rules_for_layer(["dim_customer", "fact_sales"]),
                                 tiny.model).collect()
    by_id = {r.rule_id: r for r in counts}
    assert by_id["accepted_values_dim_customer_customer_type"].status == "fail"
    assert by_id["not_null_dim_customer_customer_id"].status == "pass"
    with pytest.raises(quality.LayerGateError):
        quality.gate(counts)


def test_top10_keeps_ties_and_dense_rank(spark):
    rows = [(f"p{i}", Decimal(100 - i)) for i in range(10)] + [("p10", Decimal(91))]
    df = spark.createDataFrame(rows, "name string, net_sales decimal(38,4)").repartition(3)
    top = {r.name for r in top_n_with_ties(df, "net_sales", 10).collect()}
    assert len(top) == 11 and "p10" in top             # tied 10th place kept
    ranked = {r.name: r.rank for r in global_dense_rank(df, "net_sales", "rank", 4).collect()}
    assert ranked["p0"] == 1 and ranked["p9"] == 10 and ranked["p10"] == 10


def test_dense_rank_matches_window_on_random_data(spark):
    import random
    random.seed(7)
    rows = [(i, random.randint(0, 50)) for i in range(500)] + [(1000, None)]
    df = spark.createDataFrame(rows, "id int, v int")
    got = {r.id: r.rank for r in global_dense_rank(df, "v", "rank", 7).collect()}
    distinct = sorted({v for _, v in rows if v is not None}, reverse=True)
    expected = {i: (distinct.index(v) + 1 if v is not None else None) for i, v in rows}
    assert got == expected


def test_contracts(tiny):
    assert contract_violations("fact_sales", tiny.fact_sales) == []
    assert contract_violations("dim_date", tiny.dim_date) == []
    bad = tiny.dim_product.withColumn("product_id", F.col("product_id").cast("int"))
    with pytest.raises(ContractError):
        enforce("dim_product", bad)


def test_pipeline_gate_stops_after_recording_evidence(spark, tmp_dir):
    from starwright.plans.pipeline import run_layers
    from starwright.sources.fixtures import raw_sources
    from starwright.sources.tables import Tables

    def fresh():
        return Warehouse(raw_sources(Tables(spark, "/root/testdata/sf0.001")),
                         as_of=dt.date(2025, 6, 30))

    # the header subtotal never reconciles on the driver data (FIXTURES: Q-18
    # returns rows), so the intermediate gate stops the run before analytics
    with pytest.raises(quality.LayerGateError) as err:
        run_layers(fresh(), tmp_dir, "inv-1", "2025-06-30 00:00:00")
    assert "assert_sales_order_subtotals_match" in str(err.value)
    results = spark.read.parquet(f"{tmp_dir}/_quality/results")
    assert {r.layer for r in results.select("layer").distinct().collect()} == {
        "staging", "intermediate"}
    store = f"{tmp_dir}/_quality/evidence"
    failures = evidence.evidence(spark, store)
    assert failures.where("test_id = 'assert_sales_order_subtotals_match'").count() > 0

    # analytics alone: the Unknown customer type fails an error rule, the
    # territory-group rule only warns; no table of the layer is published
    with pytest.raises(quality.LayerGateError) as err:
        run_layers(fresh(), tmp_dir, "inv-2", "2025-06-30 00:00:00", layers=("analytics",))
    assert "accepted_values_dim_customer_customer_type" in str(err.value)
    res = spark.read.parquet(f"{tmp_dir}/_quality/results").where("invocation_id = 'inv-2'")
    warn = res.where("rule_id = 'accepted_values_dim_sales_territory_territory_group'").first()
    assert warn.status == "warn"
    rec = evidence.evidence(spark, store).where(
        "invocation_id = 'inv-2' AND test_id = 'accepted_values_dim_customer_customer_type'").first()
    assert '"value_field":"Unknown"' in rec.failure_record
    from starwright.operators.upsert import current_version
    assert current_version(spark, f"{tmp_dir}/analytics/fact_sales") is None


def test_broken_constraints_stop_the_publish(spark, tmp_dir, tiny):
    from starwright.operators.upsert import current_version
    from starwright.plans.pipeline import run_layers

    product = tiny.model("dim_product")
    for name, faulty in (("pk", product.unionAll(product)),
                         ("fk", product.where("product_id <> 7 and false"))):
        tiny.materialized["dim_product"] = faulty
        out = f"{tmp_dir}/{name}"
        with pytest.raises(constraints.ConstraintError) as err:
            run_layers(tiny, out, "inv", "2025-06-30 00:00:00", layers=("analytics",))
        assert f"product_id_{name}" in str(err.value)
        assert current_version(spark, f"{out}/analytics/dim_product") is None


def test_lineage_closure_on_a_diamond(spark):
    from starwright.operators.closure import descendants
    edges = spark.createDataFrame(
        [("s", "a"), ("s", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("x", "y")],
        "parent string, child string")
    roots = spark.createDataFrame([("s",), ("x",), ("lonely",)], "root string")
    got = sorted(tuple(r) for r in descendants(edges, roots).collect())
    assert got == [("lonely", "lonely"), ("s", "a"), ("s", "b"), ("s", "c"), ("s", "d"),
                   ("s", "s"), ("x", "x"), ("x", "y")]


def test_dense_rank_with_empty_range_partitions(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 9)], "id int, v int")
    got = {r.id: r.rank for r in global_dense_rank(df, "v", "rank", 16).collect()}
    assert got == {1: 2, 2: 2, 3: None, 4: 1}


def test_latest_breaks_ties_on_the_key(spark):
    from starwright.plans.reports import latest
    df = spark.createDataFrame([("r1", 5), ("r3", 5), ("r2", 4)], "run_id string, started_at int")
    assert latest(df, "started_at", "run_id").first().run_id == "r3"


def test_a_discount_of_ten_or_more_is_flagged_not_fatal(spark):
    rows = [(1, "2.0000", "0.1500"), (3, "100.0000", "10.0000"), (1, "1.0000", "123456.7891"),
            (2, "5.0000", None)]
    df = spark.createDataFrame(rows, "q int, p string, d string").selectExpr(
        "cast(q as smallint) q", "cast(p as decimal(19,4)) p", "cast(d as decimal(19,4)) d")
    got = [tuple(r) for r in df.select(*line_amounts(F.col("q"), F.col("p"), F.col("d"))).collect()]
    exact = [(int(q) * Decimal(p), Decimal(d)) for q, p, d in rows if d]
    assert [g[0] for g in got[:3]] == [g for g, _ in exact] and got[3][1:] == (None, None)
    assert [g[1:] for g in got[:3]] == [(g * d, g * (1 - d)) for g, d in exact]


def test_long_keys_stay_whole(spark):
    from starwright.functions.columns import padded, uuid_from_key
    keys = [7, 999_999_999_999, 1_000_000_000_000, 10_000_000_000_007]
    got = [tuple(r) for r in spark.createDataFrame([(k,) for k in keys], "k long").select(
        uuid_from_key("k"), padded("k", 10)).collect()]
    assert len(set(got)) == 4 and got[0] == ("00000000-0000-4000-8000-000000000007", "0000000007")
    assert [a.endswith(str(k)) and b.endswith(str(k)) for k, (a, b) in zip(keys, got, strict=True)]


def test_detail_ids_of_an_order_of_many_lines(spark):
    from starwright.sources.fixtures import detail_id
    lines = spark.range(250).selectExpr(
        "1 + id % 2 as l_orderkey", "id as l_partkey", "id as l_suppkey", "id as l_linenumber",
        "1 as l_quantity", "1 as l_extendedprice", "0 as l_discount", "0 as l_tax",
        "'N' as l_returnflag", "'O' as l_linestatus", "date'2024-01-01' as l_shipdate")
    assert lines.select(detail_id()).distinct().count() == 250


def test_each_run_has_its_own_graph(spark):
    from starwright.operators.closure import graph_of_run, reachable
    schema = "orchestrator_run_id string, node string, is_root boolean, depends_on array<string>"
    chain = [("s", True, None), ("a", False, ["s"]), ("b", False, ["a", "gone"])]
    cut = [("s", True, []), ("a", False, ["s"]), ("b", False, [])]
    loop = [("s", True, None), ("a", False, ["s", "b"]), ("b", False, ["a"]), ("c", False, ["b"])]
    rows = ([("1", *n) for n in chain] + [("2", *n) for n in reversed(chain)]
            + [("3", *n) for n in cut] + [("4", *n) for n in loop] + [("4", *loop[0])])
    nodes = spark.createDataFrame(rows, schema)
    graphs = {r.orchestrator_run_id: r.graph for r in graph_of_run(nodes).collect()}
    assert graphs["1"] == graphs["2"] and len(set(graphs.values())) == 3
    named = nodes.where("orchestrator_run_id <> '2'").withColumnRenamed(
        "orchestrator_run_id", "graph")
    got = sorted(tuple(r) for r in reachable(named).collect())
    assert got == [("1", "s", "a"), ("1", "s", "b"), ("1", "s", "s"), ("3", "s", "a"),
                   ("3", "s", "s"), ("4", "s", "a"), ("4", "s", "b"), ("4", "s", "c"),
                   ("4", "s", "s")]
    assert reachable(named.limit(0)).count() == 0


def test_deep_graphs_are_labelled_in_one_pass():
    from starwright.operators.closure import labels
    deep = {"n0": set(), **{f"n{i}": {f"n{i - 1}"} for i in range(1, 5000)}}
    assert set(labels(deep, {"n0"}).values()) == {1}
    wide = {"x": set(), "y": set(), "z": {"x", "y"}}
    assert labels(wide, {"x", "y"}) == {"x": 1, "y": 2, "z": 3}


def test_profile_follows_the_schema_of_run_time(spark):
    from starwright.plans import profile
    rows = [(1, "a", None, dt.date(2024, 1, 5)), (1, None, "a", dt.date(2024, 1, 5)),
            (1, "a", None, dt.date(2024, 1, 9)), (1, "a", None, dt.date(2024, 1, 5)),
            (None, "b", "b", dt.date(2024, 4, 1)), (2, "", None, None)]
    schema = "`a.b` int, s string, t string, some_month date"
    df = spark.createDataFrame(rows, schema).withColumn("m", F.create_map(F.lit("k"), "s"))
    wide = df.select("*", *(F.lit(None).cast("int").alias(f"n{i}") if i % 2 else
                            F.lit(i).alias(f"n{i}") for i in range(70)))
    for table, more in ((df, 0), (wide, 70)):
        p = profile.table_profile("new_model", table).first()
        assert (p.rows, p.columns, p.duplicate_rows) == (6, 5 + more, 1)
        assert p.null_cells == 7 + more // 2 * 6 and p.null_columns == 4 + more // 2
        assert (p.months_actual, p.months_expected, p.volume_anomaly) == (2, 4, "warning")
    empty = profile.table_profile("new_model", df.limit(0)).first()
    assert (empty.rows, empty.duplicate_rows, empty.null_cells, empty.months_expected) == (0,) * 4


def test_latest_manifest_names_the_models(spark):
    from starwright.plans import profile
    nodes = spark.createDataFrame(
        [("old", "fact", "model", "analytics"), ("new", "fact", "model", "analytics"),
         ("new", "added", "model", "analytics"), ("new", "stg", "model", "staging"),
         ("new", "raw", "source", None), ("unstored", "x", "model", "analytics")],
        "orchestrator_run_id string, node_name string, resource_type string, layer string")
    runs = spark.createDataFrame(
        [("i1", "old", 1), ("i2", "new", 2), ("i3", "without manifest", 3)],
        "invocation_id string, orchestrator_run_id string, collected_at int")
    assert profile.latest_models(nodes, runs) == ["added", "fact"]


def test_skewed_keys_give_even_ranges(spark):
    from starwright.sources.snapshot import key_bounds, range_predicates
    # half of the keys lie in the last thousandth of the key space, one holds a fifth
    keys = (spark.range(4000).select(F.col("id") * 1000)
            .union(spark.range(4000).select(F.col("id") + 4_000_000))
            .union(spark.range(2000).select(F.lit(77)))
            .union(spark.createDataFrame([(None,)] * 5, "id long"))).toDF("k")
    parts = range_predicates("k", key_bounds(keys, "k", 10))
    counts = [keys.where(p).count() for p in parts]
    assert sum(counts) == keys.count() and max(counts) <= 2100 and len(counts) >= 9
    assert sorted(counts)[:-1][-1] <= 1200
    assert range_predicates("k", key_bounds(keys.limit(0), "k", 10)) == ["1 = 1"]
    assert key_bounds(keys, "k", 1) == []
