"""Driver tables → reference-shaped raw source tables.

The engine's models expect the ten order-management sources (header, detail,
customer, person, store, product, territory, special offer, sales person,
employee) with their raw column names plus ``_loaded_at`` / ``_source_table``.
The driver ships TPC-H-like tables instead; this module derives each raw table
with a deterministic mapping that DuckDB can express too (see FIXTURES.md):

* header ← orders (+ the customer's nation as territory), detail ← lineitem;
* customer ← customer: a person when ``custkey % 10`` in 0–6, a store when in
  5–8 (9 → neither);
* person ← customers (id ``2·custkey``) and suppliers (id ``2·suppkey+1``),
  names split from ``c_name`` / ``s_name`` on ``#``;
* sales person / employee ← supplier (id ``2·suppkey+1``);
* product ← part; territory ← nation ⋈ region; special offer ← the distinct
  discount levels of lineitem (at most 101: ``round(discount·100)+1``).

Lines carry two stand-in columns the real header owns (``shipdate``,
``salespersonid``) because the driver keeps them per line; the intermediate
model prefers header values and falls back to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.columns import days_after, padded, uuid_from_key
from starwright.sources.tables import Tables

# One load time for every raw table of a run (the snapshot's ``_loaded_at``).
DEFAULT_LOADED_AT = "2001-08-02 06:00:00"


def _meta(schema_table: str, loaded_at: str) -> list:
    return [
        F.expr(f"timestamp_ntz'{loaded_at}'").alias("_loaded_at"),
        F.lit(schema_table).alias("_source_table"),
    ]


LINES = 1_000_000


def detail_id(order_key: str = "l_orderkey") -> F.Column:
    """``l_orderkey·LINES + row_number()`` within the order, ordered by every
    other lineitem column: unique and deterministic because no line is fully
    duplicated; the window shares the join's partitioning on the order key.
    Unique while an order has fewer than ``LINES`` lines, for order keys up to
    9·10^12; the uniqueness rule flags an order beyond that."""
    w = Window.partitionBy(order_key).orderBy(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return F.col(order_key) * LINES + F.row_number().over(w)


def raw_salesorderheader(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    o = t.orders("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority")
    c = t.customer("c_custkey", "c_nationkey")
    online = F.col("o_orderpriority") == "5-LOW"
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("salesorderid"),
        F.lit(8).cast("smallint").alias("revisionnumber"),
        F.col("o_orderdate").alias("orderdate"),
        (F.col("o_orderdate") + F.expr("INTERVAL 12 DAYS")).alias("duedate"),
        F.lit(None).cast("timestamp_ntz").alias("shipdate"),
        F.when(F.col("o_orderstatus") == "F", 5).when(F.col("o_orderstatus") == "P", 2)
        .otherwise(1).cast("smallint").alias("status"),
        online.alias("onlineorderflag"),
        F.when(~online, F.concat(F.lit("PO"), F.col("o_orderkey").cast("string")))
        .alias("purchaseordernumber"),
        F.concat(F.lit("10-"), padded("o_custkey", 10))
        .alias("accountnumber"),
        F.col("o_custkey").alias("customerid"),
        F.lit(None).cast("bigint").alias("salespersonid"),
        F.col("c_nationkey").alias("territoryid"),
        F.col("o_custkey").alias("billtoaddressid"),
        F.col("o_custkey").alias("shiptoaddressid"),
        F.when(online, 1).otherwise(5).alias("shipmethodid"),
        F.lit(None).cast("int").alias("creditcardid"),
        F.lit(None).cast("string").alias("creditcardapprovalcode"),
        F.lit(None).cast("int").alias("currencyrateid"),
        F.col("o_totalprice").alias("subtotal"),
        F.lit(0.0).alias("taxamt"),
        F.lit(0.0).alias("freight"),
        F.col("o_totalprice").alias("totaldue"),
        F.lit(None).cast("string").alias("comment"),
        uuid_from_key(F.col("o_orderkey")).alias("rowguid"),
        (F.col("o_orderdate") + F.expr("INTERVAL 12 DAYS")).alias("modifieddate"),
        *_meta("sales.salesorderheader", loaded_at),
    )


def raw_salesorderdetail(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    li = t.lineitem("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate")
    return li.withColumn("salesorderdetailid", detail_id()).select(
        F.col("l_orderkey").alias("salesorderid"),
        "salesorderdetailid",
        F.lit(None).cast("string").alias("carriertrackingnumber"),
        F.col("l_quantity").alias("orderqty"),
        F.col("l_partkey").alias("productid"),
        (F.round(F.col("l_discount") * 100).cast("int") + 1).alias("specialofferid"),
        F.col("l_extendedprice").alias("unitprice"),
        F.col("l_discount").alias("unitpricediscount"),
        uuid_from_key(F.col("salesorderdetailid")).alias("rowguid"),
        F.col("l_shipdate").alias("modifieddate"),
        *_meta("sales.salesorderdetail", loaded_at),
        # stand-ins for header attributes the driver keeps per line
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("shipdate"),
        (F.col("l_suppkey") * 2 + 1).alias("salespersonid"),
    )


def raw_customer(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    c = t.customer("c_custkey", "c_nationkey")
    m = F.col("c_custkey") % 10
    return c.select(
        F.col("c_custkey").alias("customerid"),
        F.when(m <= 6, F.col("c_custkey") * 2).alias("personid"),
        F.when((m >= 5) & (m <= 8), F.col("c_custkey")).alias("storeid"),
        F.col("c_nationkey").alias("territoryid"),
        uuid_from_key(F.col("c_custkey")).alias("rowguid"),
        days_after("2001-01-01 00:00:00", F.col("c_custkey") % 40).alias("modifieddate"),
        *_meta("sales.customer", loaded_at),
    )


def _person_rows(df: DataFrame, key: F.Column, name: str, person_type: str) -> DataFrame:
    parts = F.split(F.col(name), "#")
    return df.select(
        key.alias("businessentityid"),
        F.lit(person_type).alias("persontype"),
        F.lit(False).alias("namestyle"),
        F.lit(None).cast("string").alias("title"),
        F.element_at(parts, 1).alias("firstname"),
        F.when(key % 3 == 0, F.lit("M")).alias("middlename"),
        F.element_at(parts, 2).alias("lastname"),
        F.lit(None).cast("string").alias("suffix"),
        (key % 3).cast("int").alias("emailpromotion"),
        F.lit(None).cast("string").alias("additionalcontactinfo"),
        F.lit(None).cast("string").alias("demographics"),
        uuid_from_key(key).alias("rowguid"),
        days_after("2001-01-15 00:00:00", key % 40).alias("modifieddate"),
    )


def raw_person(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    cust = t.customer("c_custkey", "c_name").filter(F.col("c_custkey") % 10 <= 6)
    sup = t.supplier("s_suppkey", "s_name")
    people = _person_rows(cust, F.col("c_custkey") * 2, "c_name", "IN").unionByName(
        _person_rows(sup, F.col("s_suppkey") * 2 + 1, "s_name", "SP")
    )
    return people.select("*", *_meta("person.person", loaded_at))


def raw_store(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    m = F.col("c_custkey") % 10
    c = t.customer("c_custkey").filter((m >= 5) & (m <= 8))
    return c.select(
        F.col("c_custkey").alias("businessentityid"),
        F.concat(F.lit("Store "), F.col("c_custkey").cast("string")).alias("name"),
        F.lit(None).cast("bigint").alias("salespersonid"),
        F.lit(None).cast("string").alias("demographics"),
        uuid_from_key(F.col("c_custkey")).alias("rowguid"),
        days_after("2001-02-01 00:00:00", F.col("c_custkey") % 20).alias("modifieddate"),
        *_meta("sales.store", loaded_at),
    )


def raw_product(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    p = t.part("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("productid"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string"))
        .alias("productnumber"),
        (F.col("p_size") > 25).alias("makeflag"),
        F.lit(True).alias("finishedgoodsflag"),
        F.lit(None).cast("string").alias("color"),
        (F.col("p_size") * 10).cast("smallint").alias("safetystocklevel"),
        (F.col("p_size") * 5).cast("smallint").alias("reorderpoint"),
        F.col("p_retailprice").alias("standardcost"),
        F.col("p_retailprice").alias("listprice"),
        F.col("p_size").cast("string").alias("size"),
        F.lit("CM ").alias("sizeunitmeasurecode"),
        F.lit(None).cast("string").alias("weightunitmeasurecode"),
        F.lit(None).cast("double").alias("weight"),
        (F.col("p_size") % 5).alias("daystomanufacture"),
        F.concat(F.lit(" "), F.substring("p_type", 1, 1)).alias("productline"),
        F.lit(None).cast("string").alias("class"),
        F.lit(None).cast("string").alias("style"),
        (F.col("p_size") % 37 + 1).alias("productsubcategoryid"),
        F.lit(None).cast("int").alias("productmodelid"),
        F.expr("timestamp_ntz'1995-01-01 00:00:00'").alias("sellstartdate"),
        F.lit(None).cast("timestamp_ntz").alias("sellenddate"),
        F.lit(None).cast("timestamp_ntz").alias("discontinueddate"),
        uuid_from_key(F.col("p_partkey")).alias("rowguid"),
        days_after("2001-03-01 00:00:00", F.col("p_partkey") % 30).alias("modifieddate"),
        *_meta("production.product", loaded_at),
    )


def raw_salesterritory(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    n = t.nation("n_nationkey", "n_name", "n_regionkey")
    r = t.region("r_regionkey", "r_name")
    # nation/region are fixed-size reference tables: broadcasting them is bounded
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("territoryid"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("countryregioncode"),
        F.col("r_name").alias("group"),
        F.lit(0.0).alias("salesytd"),
        F.lit(0.0).alias("saleslastyear"),
        F.lit(0.0).alias("costytd"),
        F.lit(0.0).alias("costlastyear"),
        uuid_from_key(F.col("n_nationkey")).alias("rowguid"),
        days_after("2001-01-01 00:00:00", F.col("n_nationkey")).alias("modifieddate"),
        *_meta("sales.salesterritory", loaded_at),
    )


def raw_specialoffer(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    # distinct discount levels: a partial (map-side) aggregate over lineitem whose
    # output is bounded by the 101 possible levels of a [0, 1] discount
    levels = (
        t.lineitem("l_discount")
        .select((F.round(F.col("l_discount") * 100).cast("int") + 1).alias("specialofferid"))
        .distinct()
    )
    pct = F.col("specialofferid") - 1
    no_discount = pct == 0
    return levels.select(
        "specialofferid",
        F.concat(F.lit("Discount "), pct.cast("string"), F.lit("%")).alias("description"),
        (pct / 100).alias("discountpct"),
        F.when(no_discount, "No Discount").otherwise("Volume Discount").alias("type"),
        F.when(no_discount, "No Discount").otherwise("Reseller").alias("category"),
        F.expr("timestamp_ntz'1995-01-01 00:00:00'").alias("startdate"),
        F.expr("timestamp_ntz'2001-12-31 00:00:00'").alias("enddate"),
        F.lit(0).alias("minqty"),
        F.lit(None).cast("int").alias("maxqty"),
        uuid_from_key(F.col("specialofferid")).alias("rowguid"),
        days_after("2001-01-01 00:00:00", F.col("specialofferid")).alias("modifieddate"),
        *_meta("sales.specialoffer", loaded_at),
    )


def raw_salesperson(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    s = t.supplier("s_suppkey", "s_nationkey", "s_acctbal")
    key = F.col("s_suppkey") * 2 + 1
    return s.select(
        key.alias("businessentityid"),
        F.col("s_nationkey").alias("territoryid"),
        F.when(F.col("s_suppkey") % 4 != 0, F.abs(F.col("s_acctbal")) * 100).alias("salesquota"),
        F.abs(F.col("s_acctbal")).alias("bonus"),
        ((F.col("s_suppkey") % 3) / 100).alias("commissionpct"),
        F.lit(0.0).alias("salesytd"),
        F.lit(0.0).alias("saleslastyear"),
        uuid_from_key(key).alias("rowguid"),
        days_after("2001-01-01 00:00:00", F.col("s_suppkey") % 30).alias("modifieddate"),
        *_meta("sales.salesperson", loaded_at),
    )


def raw_employee(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    s = t.supplier("s_suppkey")
    k = F.col("s_suppkey")
    key = k * 2 + 1
    return s.select(
        key.alias("businessentityid"),
        k.cast("string").alias("nationalidnumber"),
        F.concat(F.lit("sp"), k.cast("string")).alias("loginid"),
        F.lit("Sales Representative").alias("jobtitle"),
        F.date_add(F.lit("1970-01-01").cast("date"), (k % 3650).cast("int")).alias("birthdate"),
        F.when(k % 2 == 0, "M").otherwise("S").alias("maritalstatus"),
        F.when(k % 3 == 0, "F").otherwise("M").alias("gender"),
        F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int")).alias("hiredate"),
        (k % 2 == 0).alias("salariedflag"),
        (k % 100).cast("smallint").alias("vacationhours"),
        (k % 70).cast("smallint").alias("sickleavehours"),
        F.lit(True).alias("currentflag"),
        uuid_from_key(key).alias("rowguid"),
        days_after("2001-02-01 00:00:00", k % 20).alias("modifieddate"),
        F.concat(F.lit("/1/"), k.cast("string"), F.lit("/")).alias("organizationnode"),
        *_meta("humanresources.employee", loaded_at),
    )


RAW_BUILDERS = {
    "salesorderheader": raw_salesorderheader,
    "salesorderdetail": raw_salesorderdetail,
    "customer": raw_customer,
    "person": raw_person,
    "store": raw_store,
    "product": raw_product,
    "salesterritory": raw_salesterritory,
    "specialoffer": raw_specialoffer,
    "salesperson": raw_salesperson,
    "employee": raw_employee,
}


class RawSources(dict):
    """The ten raw tables, each built on first access."""

    def __init__(self, t: Tables, loaded_at: str = DEFAULT_LOADED_AT):
        super().__init__()
        self.t = t
        self.loaded_at = loaded_at

    def __missing__(self, name: str) -> DataFrame:
        df = RAW_BUILDERS[name](self.t, self.loaded_at)
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in RAW_BUILDERS


def raw_sources(t: Tables, loaded_at: str = DEFAULT_LOADED_AT) -> RawSources:
    """All ten raw tables (each built lazily)."""
    return RawSources(t, loaded_at)
