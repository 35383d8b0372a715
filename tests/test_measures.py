"""Measure semantics on a hand-made fact (gap month, blanks, recurring customers)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starwright.plans import calendar
from starwright.plans import context as C
from starwright.plans import measures as M

LINES = "sales_order_id bigint, customer_id bigint, product_id bigint, sales_person_id bigint, " \
        "territory_id int, order_date_id int, order_quantity smallint, unit_price decimal(19,4), " \
        "net_amount decimal(19,4)"


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        # order, customer, product, sp, territory, date, qty, price, net
        (1, 10, 1, 5, 1, 20240110, 1, Decimal("100"), Decimal("100")),
        (2, 10, 2, 5, 1, 20240120, 1, Decimal("20"), Decimal("20")),     # customer 10: 2 orders
        (3, 11, 1, None, 2, 20240315, 2, Decimal("25"), Decimal("50")),  # no sales person
        (4, 12, 3, 6, 1, 20250105, 1, Decimal("10"), Decimal("10")),
    ]
    return spark.createDataFrame(rows, LINES)


@pytest.fixture(scope="module")
def months(spark, lines):
    dates = lines.select(F.to_date(F.col("order_date_id").cast("string"), "yyyyMMdd")
                         .alias("date_value"))
    dim = calendar.dim_date(dates, dt.date(2025, 6, 30), 0)
    return {(r.year_number, r.month_number): r for r in M.month_grain(lines, dim).collect()}


def test_ytd_carries_forward_and_gap_month_is_blank(months):
    jan, feb, mar = months[(2024, 1)], months[(2024, 2)], months[(2024, 3)]
    assert jan.net_sales == Decimal("120") and feb.net_sales is None
    assert feb.net_sales_ytd == Decimal("120") and mar.net_sales_ytd == Decimal("170")
    assert months[(2024, 12)].net_sales_ytd == Decimal("170")      # carried to year end


def test_moving_average_skips_months_without_sales(months):
    assert months[(2024, 3)].moving_avg_3m == pytest.approx((120 + 50) / 2)
    assert months[(2024, 4)].moving_avg_3m == pytest.approx(50.0)


def test_prior_period_and_growth_need_both_sides(months):
    mar = months[(2024, 3)]
    assert mar.net_sales_pm is None and mar.mom_growth is None and mar.mom_change is None
    jan25 = months[(2025, 1)]
    assert jan25.net_sales_ly == Decimal("120")
    assert jan25.yoy_growth == pytest.approx((10 - 120) / 120)
    assert jan25.net_sales_ytd_ly == Decimal("120")
    assert months[(2024, 1)].share_of_year == pytest.approx(120 / 170)
    assert (2023, 12) not in months          # nothing to show before the first sale


def test_recurring_customers_inside_the_group(spark, lines):
    terr = spark.createDataFrame([(1, "North"), (2, "South")], "territory_id int, territory_name string")
    rows = {r.territory_name: r for r in M.territory_grain(lines, terr).collect()}
    n = rows["North"]
    assert (n.active_customers, n.recurring_customers, n.one_time_customers) == (2, 1, 1)
    assert n.sales_recurring == Decimal("120") and n.sales_one_time == Decimal("10")
    assert n.orders_per_recurring == pytest.approx(2.0)
    assert n.ticket_index_recurring == pytest.approx((120 / 2) / (10 / 1))
    s = rows["South"]
    assert s.recurring_customers is None and s.one_time_customers == 1   # blank, not 0
    assert s.share_recurring is None
    assert n.territory_share_sales == pytest.approx(130 / 180)
    assert rows["North"].territory_rank_sales == 1 and rows["South"].territory_rank_sales == 2


def test_sales_person_blank_member_is_kept_but_unranked(spark, lines):
    sp = spark.createDataFrame([(5, "Ann Lee"), (6, "Bo Li")], "sales_person_id bigint, full_name string")
    rows = {r.full_name: r for r in M.sales_person_grain(lines, sp).collect()}
    assert rows[None].net_sales == Decimal("50") and rows[None].salesperson_rank_sales is None
    assert rows["Ann Lee"].salesperson_rank_sales == 1
    assert rows["Ann Lee"].salesperson_share_sales == pytest.approx(120 / 180)   # denominator keeps blanks


def test_overall_cards(spark, lines):
    prod = spark.createDataFrame([(1, "bolt"), (2, "nut"), (3, "bolt")], "product_id bigint, product_name string")
    cust = spark.createDataFrame([(10, "A"), (11, "B"), (12, "C")], "customer_id bigint, person_name string")
    r = M.overall(lines, prod, cust).first()
    assert (r.orders, r.active_customers, r.recurring_customers) == (4, 3, 1)
    assert r.sales_top10_products == Decimal("180") and r.product_is_top10 == 1
    assert r.discount_value == Decimal("0")


def test_day_grain_prior_year_maps_leap_day(spark):
    rows = [(1, 1, 1, None, 1, 20230228, 1, Decimal("7"), Decimal("7")),
            (2, 1, 1, None, 1, 20240229, 1, Decimal("3"), Decimal("3"))]
    ln = spark.createDataFrame(rows, LINES)
    dates = ln.select(F.to_date(F.col("order_date_id").cast("string"), "yyyyMMdd").alias("date_value"))
    dim = calendar.dim_date(dates, dt.date(2024, 6, 30), 0)
    got = {r.date_id: r for r in M.day_grain(ln, dim).collect()}
    assert got[20240228].net_sales is None and got[20240228].net_sales_ly == Decimal("7")
    assert got[20240229].net_sales_ly == Decimal("7")          # 29 Feb → 28 Feb
    assert got[20240229].yoy_change == Decimal("-4")


def _context(spark, lines):
    keyed = lines.withColumn("month", (F.col("order_date_id") / 100).cast("int"))
    return C.cells(keyed, ["territory_id", "month"])


def test_distinct_counts_unite_over_cells(spark, lines):
    wide = lines.unionByName(spark.createDataFrame(
        [(5, 10, 1, None, 2, 20240116, 1, Decimal("7"), Decimal("7")),      # customer 10 again
         (5, 10, 70_000, None, 2, 20240116, 1, Decimal("3"), Decimal("3")),  # another bucket
         (6, None, 0, None, None, 20240117, 1, Decimal("1"), Decimal("1")),  # null id, null key
         (-40_000, 0, -1, None, None, 20240117, 1, Decimal("1"), Decimal("1"))], LINES))
    cells = _context(spark, wide)
    for keys in ([], ["territory_id"], ["month"], ["territory_id", "month"]):
        keyed = wide.withColumn("month", (F.col("order_date_id") / 100).cast("int"))
        want = M.by(keyed, keys) if keys else M.derived(M.totals(keyed))
        got = C.measures(cells, keys).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_removed_filters_keep_the_remaining_keys(spark, lines):
    cells = _context(spark, lines)
    got = {(r.territory_id, r.month): r for r in C.measures(
        cells, ["territory_id", "month"], F.col("territory_id") == 1, ["territory_id"]).collect()}
    assert set(got) == {(1, 202401), (1, 202501)}
    assert all(r.share_net_sales == 1.0 and r.rank_net_sales == 1 for r in got.values())
    whole = {r.territory_id: r for r in C.measures(
        cells, ["territory_id"], F.col("territory_id") == 1, ["territory_id"]).collect()}
    assert whole[1].share_net_sales == 130 / 180 and whole[1].share_orders == 3 / 4
    # territories that share a place have the same rank
    tied = lines.withColumn("net_amount", F.lit(Decimal("5")).cast("decimal(19,4)"))
    assert {r.rank_net_sales for r in C.measures(
        _context(spark, tied), ["territory_id", "month"], removed=["territory_id"]).collect()
    } == {1}


def test_context_of_an_empty_fact(spark, lines):
    cells = _context(spark, lines.limit(0))
    card = C.measures(cells, []).first()
    assert (card.net_sales, card.orders, card.line_count) == (None, 0, 0)
    assert C.measures(cells, ["month"], removed=["month"]).count() == 0
