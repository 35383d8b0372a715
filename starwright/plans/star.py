"""Sales star: intermediate items, fact, dimensions and the consumption mart.

Every builder takes upstream DataFrames and returns a lazy DataFrame, so a
whole chain (raw → staging → fact → mart) is one Catalyst plan: unused columns
are pruned to the Parquet scan and filters are pushed through the views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.functions.columns import date_key, varchar


# ------------------------------------------------------------------ B-INT
def line_amounts(qty: F.Column, price: F.Column, discount: F.Column, lenient: bool = False
                 ) -> tuple:
    """Gross, discount and net line amounts, each rounded once to (19,4).

    ``smallint · decimal(19,4)`` is exact as decimal(25,4); the discount is a
    proportion, narrowed to decimal(5,4) so ``q·p·d`` stays exact at
    decimal(31,8) and ``q·p·(1−d)`` at decimal(32,8) — no intermediate
    rounding before the single cast (Spark would otherwise round the 41-digit
    product to 38 digits first).  A discount of 10 or more, no proportion any
    more, takes that wider product, null where it doesn't fit: the rule on
    discounts has to see such a line, so it must not stop the build.  With
    ``lenient`` every amount that doesn't fit is null.
    """
    d, one = discount.try_cast("decimal(5,4)"), F.lit(1).cast("decimal(1,0)")
    gross = qty * price

    def narrow(c: F.Column) -> F.Column:
        return c.try_cast("decimal(19,4)") if lenient else c.cast("decimal(19,4)")

    def amount(exact: F.Column, wide: F.Column) -> F.Column:
        return F.when(d.isNull() & discount.isNotNull(), wide.try_cast("decimal(19,4)")) \
            .otherwise(narrow(exact))

    return (
        narrow(gross),
        amount(gross * d, gross * discount),
        amount(gross * (one - d), gross * (one - discount)),
    )


def int_sales_order_items(header: DataFrame, detail: DataFrame, also: tuple[str, ...] = ()
                          ) -> DataFrame:
    """Order lines joined to their order (inner equi-join on sales_order_id), with
    the columns ``also`` of the order behind the model's own."""
    o = header.alias("o")
    i = detail.alias("i")
    gross, disc, net = line_amounts(
        F.col("i.order_quantity"), F.col("i.unit_price"), F.col("i.unit_price_discount")
    )
    ship = F.col("o.ship_date")
    sales_person = F.col("o.sales_person_id")
    if "line_ship_date" in detail.columns:
        ship = F.coalesce(ship, F.col("i.line_ship_date"))
    if "line_sales_person_id" in detail.columns:
        sales_person = F.coalesce(
            sales_person,
            F.when(~F.col("o.is_online_order"), F.col("i.line_sales_person_id")),
        )
    return i.join(o, F.col("i.sales_order_id") == F.col("o.sales_order_id"), "inner").select(
        F.col("i.sales_order_detail_id").alias("sales_order_detail_id"),
        F.col("i.sales_order_id").alias("sales_order_id"),
        F.col("i.product_id").alias("product_id"),
        F.col("o.customer_id").alias("customer_id"),
        sales_person.alias("sales_person_id"),
        F.col("o.territory_id").alias("territory_id"),
        F.col("o.order_date").alias("order_date"),
        F.col("o.due_date").alias("due_date"),
        ship.alias("ship_date"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.is_online_order").alias("is_online_order"),
        F.col("i.order_quantity").alias("order_quantity"),
        F.col("i.unit_price").alias("unit_price"),
        F.col("i.unit_price_discount").alias("unit_price_discount"),
        gross.alias("gross_amount"),
        disc.alias("discount_amount"),
        net.alias("net_amount"),
        F.col("i.special_offer_id").alias("special_offer_id"),
        F.col("i.carrier_tracking_number").alias("carrier_tracking_number"),
        F.greatest(F.col("o.modified_at"), F.col("i.modified_at")).alias("modified_at"),
        *(F.col(f"o.{c}").alias(c) for c in also),
    )


# ----------------------------------------------------------------- B-FACT
def fact_sales(items: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    return items.select(
        "sales_order_detail_id", "sales_order_id",
        "product_id", "customer_id", "sales_person_id", "territory_id", "special_offer_id",
        date_key("order_date").alias("order_date_id"),
        date_key("due_date").alias("due_date_id"),
        F.when(F.col("ship_date").isNotNull(), date_key("ship_date")).alias("ship_date_id"),
        "order_status", "is_online_order",
        "order_quantity", "unit_price", "unit_price_discount",
        "gross_amount", "discount_amount", "net_amount",
        "carrier_tracking_number", "modified_at", *also,
    )


# ------------------------------------------------------------- dimensions
def dim_customer(customers: DataFrame, persons: DataFrame, stores: DataFrame) -> DataFrame:
    c = customers.alias("c")
    p = persons.alias("p")
    s = stores.alias("s")
    person_id, store_id = F.col("c.person_id"), F.col("c.store_id")
    return (
        c.join(p, person_id == F.col("p.business_entity_id"), "left")
        .join(s, store_id == F.col("s.business_entity_id"), "left")
        .select(
            F.col("c.customer_id").alias("customer_id"),
            person_id.alias("person_id"),
            store_id.alias("store_id"),
            F.col("c.territory_id").alias("territory_id"),
            F.concat_ws(" ", "p.first_name", "p.middle_name", "p.last_name").alias("person_name"),
            F.col("s.store_name").alias("store_name"),
            F.when(person_id.isNotNull() & store_id.isNotNull(), "Store with person")
            .when(person_id.isNotNull(), "Person")
            .when(store_id.isNotNull(), "Store")
            .otherwise("Unknown").alias("customer_type"),
            F.col("c.row_guid").alias("row_guid"),
            F.col("c.modified_at").alias("modified_at"),
            F.col("c._loaded_at").alias("_loaded_at"),
            F.col("c._source_table").alias("_source_table"),
        )
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "product_number",
        "is_manufactured", "is_finished_good",
        "color", "size", "size_unit_measure_code", "weight", "weight_unit_measure_code",
        "product_line", "product_class", "product_style",
        "safety_stock_level", "reorder_point", "days_to_manufacture",
        "standard_cost", "list_price",
        "product_subcategory_id", "product_model_id",
        "sell_start_date", "sell_end_date", "discontinued_date",
    )


def dim_sales_territory(territories: DataFrame) -> DataFrame:
    return territories.select(
        "territory_id", "territory_name", "country_region_code", "territory_group",
        "row_guid", "modified_at", "_loaded_at", "_source_table",
    )


def dim_special_offer(offers: DataFrame) -> DataFrame:
    return offers.select(
        "special_offer_id", "special_offer_description", "discount_percentage",
        "offer_type", "offer_category", "start_date", "end_date",
        "minimum_quantity", "maximum_quantity", "modified_at",
    )


def dim_sales_person(salespeople: DataFrame, employees: DataFrame, people: DataFrame) -> DataFrame:
    sp = salespeople.alias("sp")
    e = employees.alias("e")
    p = people.alias("p")
    key = F.col("sp.business_entity_id")
    return (
        sp.join(e, key == F.col("e.business_entity_id"), "left")
        .join(p, key == F.col("p.business_entity_id"), "left")
        .select(
            key.alias("sales_person_id"),
            F.col("sp.territory_id").alias("territory_id"),
            F.col("p.first_name").alias("first_name"),
            F.col("p.middle_name").alias("middle_name"),
            F.col("p.last_name").alias("last_name"),
            varchar(F.concat_ws(" ", "p.first_name", "p.middle_name", "p.last_name"), 152)
            .alias("full_name"),
            F.col("e.job_title").alias("job_title"),
            F.col("e.hire_date").alias("hire_date"),
            F.col("e.is_salaried").alias("is_salaried"),
            F.col("e.is_current").alias("is_current"),
            F.col("sp.sales_quota").alias("sales_quota"),
            F.col("sp.bonus").alias("bonus"),
            F.col("sp.commission_pct").alias("commission_pct"),
            F.greatest("sp.modified_at", "e.modified_at", "p.modified_at").alias("modified_at"),
        )
    )


# ----------------------------------------------------------------- B-MART
_PRICES = ["unit_price", "unit_price_discount"]
_AMOUNTS = ["gross_amount", "discount_amount", "net_amount"]


def packed_lines(fact: DataFrame) -> DataFrame:
    """``fact`` for a shuffle: prices in 8 bytes, and the amounts that follow from
    quantity, price and discount left out.  Where a price needs more or an amount
    is another one, ``__own`` holds all five as they are; :func:`line_money` gives
    them back for any fact."""
    short = [F.col(c).try_cast("decimal(18,4)") for c in _PRICES]
    made = line_amounts(F.col("order_quantity"), *(F.col(c) for c in _PRICES), lenient=True)
    same = F.lit(True)
    for column, value in zip(_PRICES + _AMOUNTS, [*short, *made], strict=True):
        same = same & F.col(column).eqNullSafe(value)
    rest = [c for c in fact.columns if c not in _PRICES + _AMOUNTS]
    return fact.select(
        *rest, *(s.alias(f"__{c}") for c, s in zip(_PRICES, short, strict=True)),
        F.when(~same, F.struct(*_PRICES, *_AMOUNTS)).alias("__own"))


def line_money(alias: str) -> dict[str, F.Column]:
    """The prices and amounts of :func:`packed_lines`."""
    own = F.col(f"{alias}.__own")
    prices = [F.col(f"{alias}.__{c}").cast("decimal(19,4)") for c in _PRICES]
    made = line_amounts(F.col(f"{alias}.order_quantity"), *prices, lenient=True)
    return {c: F.when(own.isNotNull(), own[c]).otherwise(value)
            for c, value in zip(_PRICES + _AMOUNTS, [*prices, *made], strict=True)}


# The places of a line's small columns in two words, as (type, bits) each.
_WORDS = {
    "__small": {"order_status": ("smallint", 7), "is_online_order": ("boolean", 1),
                "special_offer_id": ("int", 24), "territory_id": ("int", 24)},
    "__days": {"order_date_id": ("int", 28), "due_date_id": ("int", 28)},
}


def packed_words(lines: DataFrame) -> DataFrame:
    """``lines`` with the columns of each word as one bigint.  Where one is null,
    negative or too large, ``<word>_own`` holds the word's columns as they are;
    :func:`line_columns` gives them back for any line."""
    words = []
    for word, columns in _WORDS.items():
        value, fits, at = F.lit(0).cast("long"), F.lit(True), 0
        for c, (_, bits) in columns.items():
            whole = F.col(c).cast("long")
            fits = fits & F.coalesce((whole >= 0) & (whole < 1 << bits), F.lit(False))
            value, at = value.bitwiseOR(F.shiftleft(whole, at)), at + bits
        words += [F.when(fits, value).alias(word),
                  F.when(~fits, F.struct(*columns)).alias(f"{word}_own")]
    rest = [c for c in lines.columns if not any(c in columns for columns in _WORDS.values())]
    return lines.select(*rest, *words)


def line_columns(alias: str) -> dict[str, F.Column]:
    """The columns of :func:`packed_words`."""
    found = {}
    for word, columns in _WORDS.items():
        own, at = F.col(f"{alias}.{word}_own"), 0
        for c, (kind, bits) in columns.items():
            part = F.shiftright(F.col(f"{alias}.{word}"), at).bitwiseAND(F.lit((1 << bits) - 1))
            found[c] = F.when(own.isNotNull(), own[c]).otherwise(part.cast(kind))
            at += bits
    return found


# What the mart shows of a customer.
CUSTOMER = ("customer_name", "customer_type")


def customer_columns(alias: str) -> list[F.Column]:
    """:data:`CUSTOMER` from a customer dimension that is left-joined as ``alias``."""
    return [F.coalesce(F.col(f"{alias}.store_name"), F.col(f"{alias}.person_name"),
                       F.lit("Unknown")).alias("customer_name"),
            F.col(f"{alias}.customer_type").alias("customer_type")]


def with_customer(header: DataFrame, customers: DataFrame) -> DataFrame:
    """The orders with :data:`CUSTOMER`: a line has its order's customer, and there
    are fewer orders than lines to deal out by customer."""
    o, c = header.alias("o"), customers.alias("c")
    return o.join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left").select(
        *(F.col(f"o.{x}").alias(x) for x in header.columns), *customer_columns("c"))


def mart_sales_details(
    fact: DataFrame,
    products: DataFrame,
    customers: DataFrame | None,
    sales_people: DataFrame,
    territories: DataFrame,
    offers: DataFrame,
    few_sales_people: bool = False,
) -> DataFrame:
    """Wide order-line mart: the fact left-joined to five dimensions.

    Dimensions are joined on their keys; Spark broadcasts those whose measured
    size is under the broadcast threshold (territory and offer always are:
    bounded by nations and discount levels) and shuffles the rest.  The product,
    whose columns are the widest, is the last one shuffled: no shuffle carries
    them.  ``few_sales_people`` are broadcast after that, so none carries their
    names either.  The lines go packed.  Without ``customers`` the fact's lines have
    :data:`CUSTOMER` from their orders (:func:`with_customer`).
    """
    kinds = dict(fact.dtypes)
    lines, line = fact, {c: F.col(f"f.{c}") for c in fact.columns}
    if all(kinds[c] == "decimal(19,4)" for c in _PRICES + _AMOUNTS):
        lines = packed_lines(lines)
        line.update(line_money("f"))
    if all(kinds[c] == kind for word in _WORDS.values() for c, (kind, _) in word.items()):
        lines = packed_words(lines)
        line.update(line_columns("f"))
    f = lines.alias("f")
    p = products.alias("p")
    sp = sales_people.alias("sp")
    t = territories.alias("t")
    o = offers.alias("o")
    person = F.col("f.sales_person_id") == F.col("sp.sales_person_id")
    joined = f if few_sales_people else f.join(sp, person, "left")
    customer = [F.col(f"f.{x}").alias(x) for x in CUSTOMER]
    if customers is not None:
        customer = customer_columns("c")
        joined = joined.join(customers.alias("c"),
                             F.col("f.customer_id") == F.col("c.customer_id"), "left")
    joined = joined.join(p, F.col("f.product_id") == F.col("p.product_id"), "left")
    if few_sales_people:
        joined = joined.join(F.broadcast(sp), person, "left")
    joined = (
        joined.join(t, line["territory_id"] == F.col("t.territory_id"), "left")
        .join(o, line["special_offer_id"] == F.col("o.special_offer_id"), "left")
    )
    return joined.select(
        F.col("f.sales_order_detail_id").alias("sales_order_detail_id"),
        F.col("f.sales_order_id").alias("sales_order_id"),
        line["order_date_id"].alias("order_date_id"),
        line["due_date_id"].alias("due_date_id"),
        F.col("f.ship_date_id").alias("ship_date_id"),
        F.col("p.product_name").alias("product_name"),
        F.col("p.product_number").alias("product_number"),
        F.col("p.product_subcategory_id").alias("product_subcategory_id"),
        F.col("p.product_model_id").alias("product_model_id"),
        F.col("p.color").alias("product_color"),
        F.col("p.size").alias("product_size"),
        F.col("p.product_line").alias("product_line"),
        F.col("p.product_class").alias("product_class"),
        F.col("p.product_style").alias("product_style"),
        *customer,
        F.col("sp.full_name").alias("sales_person_name"),
        F.col("sp.job_title").alias("sales_person_job_title"),
        F.col("t.territory_name").alias("territory_name"),
        F.col("t.country_region_code").alias("country_region_code"),
        F.col("t.territory_group").alias("territory_group"),
        F.col("o.special_offer_description").alias("special_offer_description"),
        F.col("o.offer_type").alias("offer_type"),
        F.col("o.offer_category").alias("offer_category"),
        F.col("o.discount_percentage").alias("discount_percentage"),
        line["order_status"].alias("order_status"),
        line["is_online_order"].alias("is_online_order"),
        F.col("f.order_quantity").alias("order_quantity"),
        line["unit_price"].alias("unit_price"),
        line["unit_price_discount"].alias("unit_price_discount"),
        line["gross_amount"].alias("gross_amount"),
        line["discount_amount"].alias("discount_amount"),
        line["net_amount"].alias("net_amount"),
        F.col("f.carrier_tracking_number").alias("carrier_tracking_number"),
        F.col("f.modified_at").alias("modified_at"),
    )
