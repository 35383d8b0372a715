"""Plans whose shuffles, writes and memory grow no faster than their input."""

import datetime as dt

from pyspark.sql import functions as F

from starwright.operators import constraints
from starwright.operators.runlog import fold
from starwright.plans import cells as C
from starwright.plans import measures as M
from starwright.plans import star
from starwright.plans.warehouse import Warehouse

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folds_sort_a_bit_for_each_column_not_its_name(spark):
    log = spark.createDataFrame(
        [(1, 1, ["a"], 5, 6), (1, 2, ["b"], 7, None)],
        "k long, seq int, written array<string>, a int, b int")
    assert fold(log, ["k"]).collect() == [(1, 5, None)]
    aggregates = [x for x in plan(fold(log, ["k"])).splitlines() if "Aggregate" in x]
    assert aggregates and not any("array_contains" in x for x in aggregates)


def test_keys_stay_fixed_width(spark):
    people = spark.createDataFrame([(1, 1), (2, 9), (None, 9)],
                                   "sales_person_id long, territory_id int")
    found = constraints.key_violations(
        "dim_sales_person", people, lambda model: people.select("territory_id").where("false"))
    assert "cast(sales_person_id" not in plan(found)
    assert sorted(r.violations for r in found.collect()) == [1, 3]
    # dates are days, any other type goes as text
    for value, kind in ((dt.date(2024, 1, 1), "date"), ("x", "string")):
        months = spark.createDataFrame([(value,), (value,), (None,)], f"sales_month {kind}")
        found = constraints.key_violations("fact_sales_monthly", months, None).collect()
        assert [(r.constraint_name, r.violations) for r in found] == [
            ("fact_sales_monthly_sales_month_pk", 2)]


def test_a_cell_of_few_ids_is_few_words(spark):
    lines = Warehouse.from_driver(spark, SMALL).fact_sales
    made = C.cells(lines, ["territory_id"])
    assert dict(made.dtypes)["bits"] == "bigint"
    assert "SortAggregate" not in plan(made)
    assert made.count() <= 3 * lines.count()
    edges = spark.createDataFrame([(i, 0, None) for i in (-1, -64, -65, 0, 63, 64, 2 ** 62, 63)],
                                  "sales_order_id long, customer_id long, product_id long") \
        .select("*", F.lit(1).alias("order_quantity"), F.lit(2).cast("decimal(19,4)")
                .alias("unit_price"), F.lit(3).cast("decimal(19,4)").alias("net_amount"))
    got = M.totals(edges).first()
    assert (got.orders, got.active_customers, got.products_sold, got.units) == (7, 1, 0, 8)


def test_members_are_counted_without_expanding_lines(spark):
    lines = M.sales_lines(Warehouse.from_driver(spark, SMALL).fact_sales)
    assert "Expand" not in plan(M.by(lines, ["sales_person_id"]))
    want = lines.groupBy("sales_person_id").agg(
        F.count_distinct("sales_order_id"), F.count_distinct("customer_id"),
        F.count_distinct("product_id"), F.count(F.lit(1))).collect()
    got = M.by(lines, ["sales_person_id"]).select(
        "sales_person_id", "orders", "active_customers", "products_sold", "line_count").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_lines_are_dealt_out_once_and_a_preview_writes_no_mart(spark):
    wh = Warehouse.from_driver(spark, SMALL, loaded_at="2001-08-03 06:00:00")
    preview = wh.mart_preview(10).collect()
    assert not {"mart_sales_details", "fact_sales", "stg_salesorderdetail"} & set(wh.materialized)
    items = plan(wh._build_int_sales_order_items())
    assert items.count("Window") == 1 and "starwright-tables" not in items
    order = "sales_order_detail_id"
    assert preview == wh.mart_sales_details.orderBy(order).limit(10).collect()
    assert preview == wh.mart_preview(10).collect()


def test_lines_go_packed_and_come_back_whole(spark):
    money = "decimal(19,4)"
    lines = spark.sql(f"""
        SELECT id, CAST(q AS SMALLINT) AS order_quantity, CAST(p AS {money}) AS unit_price,
               CAST(d AS {money}) AS unit_price_discount, CAST(g AS {money}) AS gross_amount,
               CAST(i AS {money}) AS discount_amount, CAST(n AS {money}) AS net_amount
        FROM VALUES (1, 3, 2.5, 0.1, 7.5, 0.75, 6.75), (2, 3, 2.5, 0.1, 7.5, 0.75, 6.74),
             (3, 3, 2.5, 12, 7.5, 90, -82.5), (4, NULL, 2.5, 0.1, NULL, NULL, NULL),
             (5, 3, NULL, 0.1, NULL, NULL, 1), (6, 3, 999999999999999.9999, 0, 1, 2, 3),
             (7, 30000, 99999999999999.9999, 0, NULL, NULL, NULL),
             (8, 3, 2.5, NULL, 7.5, NULL, NULL) AS t(id, q, p, d, g, i, n)""")
    packed = star.packed_lines(lines)
    assert {r.id for r in packed.where("__own IS NOT NULL").collect()} == {2, 5, 6, 7}
    back = packed.alias("f").select("id", "order_quantity", *(
        c.alias(name) for name, c in star.line_money("f").items()))
    assert back.schema.simpleString() == lines.schema.simpleString()
    assert back.orderBy("id").collect() == lines.orderBy("id").collect()


def test_the_mart_deals_lines_out_by_customer_and_product_only(spark):
    wh = Warehouse.from_driver(spark, SMALL)
    fact = wh.fact_sales
    dims = [wh.model(m) for m in ("dim_product", "dim_customer", "dim_sales_person",
                                  "dim_sales_territory", "dim_special_offer")]
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        made = wh._mart_over(fact)
        dealt = [x for x in plan(made).splitlines() if "Exchange hashpartitioning(" in x]
        assert not any("hashpartitioning(sales_person_id" in x for x in dealt)
        rows = made.exceptAll(star.mart_sales_details(fact, *dims)).count()
        assert (rows, made.count()) == (0, fact.count())
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)


def test_small_columns_go_as_words_and_come_back_whole(spark):
    lines = spark.sql("""
        SELECT id, CAST(s AS SMALLINT) AS order_status, o AS is_online_order,
               CAST(f AS INT) AS special_offer_id, CAST(t AS INT) AS territory_id,
               CAST(a AS INT) AS order_date_id, CAST(b AS INT) AS due_date_id
        FROM VALUES (1, 5, true, 3, 24, 19980206, 19980218),
                    (2, 127, false, 16777215, 16777215, 0, 99991231),
                    (3, 128, true, 1, 1, 1, 1), (4, 1, NULL, 1, 1, 1, 1),
                    (5, 1, true, 1, NULL, 1, 1), (6, 1, true, -1, 1, 1, 1),
                    (7, 1, true, 1, 1, -5, 2147483647), (8, 0, false, 0, 0, 0, NULL)
        AS t(id, s, o, f, t, a, b)""")
    packed = star.packed_words(lines)
    got = {r[0]: (r[1], r[2]) for r in packed.selectExpr(
        "id", "__small_own IS NOT NULL", "__days_own IS NOT NULL").collect()}
    assert [i for i, own in got.items() if own[0]] == [3, 4, 5, 6]
    assert [i for i, own in got.items() if own[1]] == [7, 8]
    back = packed.alias("f").select("id", *(
        c.alias(name) for name, c in star.line_columns("f").items()))
    assert back.dtypes == lines.dtypes
    assert back.orderBy("id").collect() == lines.orderBy("id").collect()


def test_a_profile_deals_out_one_hash_of_a_line(spark):
    from starwright.plans import profile
    lines = spark.range(1000).selectExpr("id", "CAST(NULL AS STRING) AS s", "id % 7 AS k")
    made = profile.table_profile("t", lines)
    dealt = [x for x in plan(made).splitlines() if "Exchange hashpartitioning(" in x]
    assert not any("__g" in x or "__mask" in x for x in dealt)
    assert (made.first().rows, made.first().duplicate_rows, made.first().null_cells) == \
        (1000, 0, 1000)
    # nulls in other places and rows that occur more often than twice
    some = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("a", None),
                                  (None, None), (None, None), ("b", None)], "s string, t string")
    assert profile.table_profile("t", some).first().duplicate_rows == 3


def test_a_mart_alone_fetches_customers_by_order_and_writes_no_items(spark):
    wh = Warehouse.from_driver(spark, SMALL, loaded_at="2001-08-04 06:00:00")
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        made = wh._build_mart_sales_details()
        dealt = [x for x in plan(made).splitlines() if "Exchange hashpartitioning(" in x]
        assert not {"int_sales_order_items", "mart_sales_details"} & set(wh.materialized)
        # lines are dealt out by order and by product, orders by customer and by order
        assert sum("l_orderkey" in x for x in dealt) == 1
        assert sum("product_id" in x for x in dealt) == 2  # lines and products
        assert sum("customer_id" in x for x in dealt) == 1  # customers
        fact = wh.fact_sales
        assert "int_sales_order_items" in wh.materialized
        again = wh._build_mart_sales_details()
        assert again.dtypes == made.dtypes
        rows = (made.exceptAll(again).count(), again.exceptAll(made).count(), made.count())
        assert rows == (0, 0, fact.count())
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)


def test_orders_keep_their_lines_whatever_their_customer(spark):
    orders = spark.sql("""
        SELECT * FROM VALUES (1, 10, 'a'), (2, 11, 'b'), (3, 12, 'c'), (4, NULL, 'd'), (5, 13, 'e')
        AS t(sales_order_id, customer_id, x)""")
    customers = spark.sql("""
        SELECT * FROM VALUES (10, 's', 'p', 'Store with person'), (11, NULL, 'p', 'Person'),
               (12, NULL, NULL, 'Unknown'), (NULL, 's', 'p', 'Store'), (10, 't', NULL, 'Store')
        AS t(customer_id, store_name, person_name, customer_type)""")
    got = star.with_customer(orders, customers)
    assert got.columns == [*orders.columns, *star.CUSTOMER]
    assert sorted(map(tuple, got.drop("x").collect()), key=str) == [
        (1, 10, "s", "Store with person"), (1, 10, "t", "Store"), (2, 11, "p", "Person"),
        (3, 12, "Unknown", "Unknown"), (4, None, "Unknown", None), (5, 13, "Unknown", None)]
