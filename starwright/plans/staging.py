"""Staging layer (P-1 … P-10): rename + cast every raw source column.

Each model is a declarative column list ``(raw name, output name, type)``; a
``varchar(n)``/``char(n)`` type truncates like the warehouse cast, ``trim:``
trims first.  Keys are ``bigint`` (the reference's ``integer`` keys would
overflow at the target scale); everything else keeps the reference's types.
Projections are lazy, so Catalyst prunes unused raw columns down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.functions.columns import varchar

META = [
    ("_loaded_at", "_loaded_at", "timestamp_ntz"),
    ("_source_table", "_source_table", "string"),
]
GUID_MOD = [("rowguid", "row_guid", "uuid"), ("modifieddate", "modified_at", "timestamp_ntz")]

MODELS: dict[str, list[tuple[str, str, str]]] = {
    "stg_customer": [
        ("customerid", "customer_id", "bigint"),
        ("personid", "person_id", "bigint"),
        ("storeid", "store_id", "bigint"),
        ("territoryid", "territory_id", "int"),
        *GUID_MOD, *META,
    ],
    "stg_employee": [
        ("businessentityid", "business_entity_id", "bigint"),
        ("nationalidnumber", "national_id_number", "varchar(15)"),
        ("loginid", "login_id", "varchar(256)"),
        ("jobtitle", "job_title", "varchar(50)"),
        ("birthdate", "birth_date", "date"),
        ("maritalstatus", "marital_status", "varchar(1)"),
        ("gender", "gender", "varchar(1)"),
        ("hiredate", "hire_date", "date"),
        ("salariedflag", "is_salaried", "boolean"),
        ("vacationhours", "vacation_hours", "smallint"),
        ("sickleavehours", "sick_leave_hours", "smallint"),
        ("currentflag", "is_current", "boolean"),
        *GUID_MOD,
        ("organizationnode", "organization_node", "string"),
        *META,
    ],
    "stg_person": [
        ("businessentityid", "business_entity_id", "bigint"),
        ("persontype", "person_type", "trim:varchar(2)"),
        ("namestyle", "name_style", "boolean"),
        ("title", "title", "varchar(8)"),
        ("firstname", "first_name", "varchar(50)"),
        ("middlename", "middle_name", "varchar(50)"),
        ("lastname", "last_name", "varchar(50)"),
        ("suffix", "suffix", "varchar(10)"),
        ("emailpromotion", "email_promotion", "int"),
        ("additionalcontactinfo", "additional_contact_info", "string"),
        ("demographics", "demographics", "string"),
        *GUID_MOD, *META,
    ],
    "stg_product": [
        ("productid", "product_id", "bigint"),
        ("name", "product_name", "varchar(50)"),
        ("productnumber", "product_number", "varchar(25)"),
        ("makeflag", "is_manufactured", "boolean"),
        ("finishedgoodsflag", "is_finished_good", "boolean"),
        ("color", "color", "varchar(15)"),
        ("safetystocklevel", "safety_stock_level", "smallint"),
        ("reorderpoint", "reorder_point", "smallint"),
        ("standardcost", "standard_cost", "decimal(19,4)"),
        ("listprice", "list_price", "decimal(19,4)"),
        ("size", "size", "varchar(5)"),
        ("sizeunitmeasurecode", "size_unit_measure_code", "trim:varchar(3)"),
        ("weightunitmeasurecode", "weight_unit_measure_code", "trim:varchar(3)"),
        ("weight", "weight", "decimal(8,2)"),
        ("daystomanufacture", "days_to_manufacture", "int"),
        ("productline", "product_line", "trim:varchar(2)"),
        ("class", "product_class", "trim:varchar(2)"),
        ("style", "product_style", "trim:varchar(2)"),
        ("productsubcategoryid", "product_subcategory_id", "int"),
        ("productmodelid", "product_model_id", "int"),
        ("sellstartdate", "sell_start_date", "timestamp_ntz"),
        ("sellenddate", "sell_end_date", "timestamp_ntz"),
        ("discontinueddate", "discontinued_date", "timestamp_ntz"),
        *GUID_MOD, *META,
    ],
    "stg_salesorderdetail": [
        ("salesorderid", "sales_order_id", "bigint"),
        ("salesorderdetailid", "sales_order_detail_id", "bigint"),
        ("carriertrackingnumber", "carrier_tracking_number", "varchar(25)"),
        ("orderqty", "order_quantity", "smallint"),
        ("productid", "product_id", "bigint"),
        ("specialofferid", "special_offer_id", "int"),
        ("unitprice", "unit_price", "decimal(19,4)"),
        ("unitpricediscount", "unit_price_discount", "decimal(19,4)"),
        *GUID_MOD, *META,
    ],
    "stg_salesorderheader": [
        ("salesorderid", "sales_order_id", "bigint"),
        ("revisionnumber", "revision_number", "smallint"),
        ("orderdate", "order_date", "timestamp_ntz"),
        ("duedate", "due_date", "timestamp_ntz"),
        ("shipdate", "ship_date", "timestamp_ntz"),
        ("status", "order_status", "smallint"),
        ("onlineorderflag", "is_online_order", "boolean"),
        ("purchaseordernumber", "purchase_order_number", "varchar(25)"),
        ("accountnumber", "account_number", "varchar(15)"),
        ("customerid", "customer_id", "bigint"),
        ("salespersonid", "sales_person_id", "bigint"),
        ("territoryid", "territory_id", "int"),
        ("billtoaddressid", "bill_to_address_id", "bigint"),
        ("shiptoaddressid", "ship_to_address_id", "bigint"),
        ("shipmethodid", "ship_method_id", "int"),
        ("creditcardid", "credit_card_id", "int"),
        ("creditcardapprovalcode", "credit_card_approval_code", "varchar(15)"),
        ("currencyrateid", "currency_rate_id", "int"),
        ("subtotal", "subtotal", "decimal(19,4)"),
        ("taxamt", "tax_amount", "decimal(19,4)"),
        ("freight", "freight", "decimal(19,4)"),
        ("totaldue", "total_due", "decimal(19,4)"),
        ("comment", "comment", "varchar(128)"),
        *GUID_MOD, *META,
    ],
    "stg_salesperson": [
        ("businessentityid", "business_entity_id", "bigint"),
        ("territoryid", "territory_id", "int"),
        ("salesquota", "sales_quota", "decimal(19,4)"),
        ("bonus", "bonus", "decimal(19,4)"),
        ("commissionpct", "commission_pct", "decimal(10,4)"),
        ("salesytd", "sales_ytd", "decimal(19,4)"),
        ("saleslastyear", "sales_last_year", "decimal(19,4)"),
        *GUID_MOD, *META,
    ],
    "stg_salesterritory": [
        ("territoryid", "territory_id", "int"),
        ("name", "territory_name", "varchar(50)"),
        ("countryregioncode", "country_region_code", "varchar(3)"),
        ("group", "territory_group", "varchar(50)"),
        ("salesytd", "sales_ytd", "decimal(19,4)"),
        ("saleslastyear", "sales_last_year", "decimal(19,4)"),
        ("costytd", "cost_ytd", "decimal(19,4)"),
        ("costlastyear", "cost_last_year", "decimal(19,4)"),
        *GUID_MOD, *META,
    ],
    "stg_specialoffer": [
        ("specialofferid", "special_offer_id", "int"),
        ("description", "special_offer_description", "varchar(255)"),
        ("discountpct", "discount_percentage", "decimal(19,4)"),
        ("type", "offer_type", "varchar(50)"),
        ("category", "offer_category", "varchar(50)"),
        ("startdate", "start_date", "timestamp_ntz"),
        ("enddate", "end_date", "timestamp_ntz"),
        ("minqty", "minimum_quantity", "int"),
        ("maxqty", "maximum_quantity", "int"),
        *GUID_MOD, *META,
    ],
    "stg_store": [
        ("businessentityid", "business_entity_id", "bigint"),
        ("name", "store_name", "varchar(50)"),
        ("salespersonid", "sales_person_id", "bigint"),
        ("demographics", "demographics", "string"),
        *GUID_MOD, *META,
    ],
}

# raw source table of each staging model
SOURCE_OF = {name: name[len("stg_"):] for name in MODELS}

# stand-in columns some raw tables may carry (see sources.fixtures)
PASS_THROUGH = {
    "stg_salesorderdetail": [
        ("shipdate", "line_ship_date", "timestamp_ntz"),
        ("salespersonid", "line_sales_person_id", "bigint"),
    ],
}


def cast_column(raw: str, type_spec: str) -> Column:
    c = F.col(f"`{raw}`")
    if type_spec.startswith("trim:"):
        c = F.trim(c)
        type_spec = type_spec[len("trim:"):]
    if type_spec.startswith("varchar("):
        return varchar(c, int(type_spec[len("varchar("):-1]))
    if type_spec == "uuid":
        return F.lower(c.cast("string"))
    return c.cast(type_spec)


def stage(name: str, raw: DataFrame) -> DataFrame:
    """Apply staging model ``name`` to its raw DataFrame."""
    cols = [cast_column(r, t).alias(o) for r, o, t in MODELS[name]]
    present = set(raw.columns)
    cols += [cast_column(r, t).alias(o) for r, o, t in PASS_THROUGH.get(name, []) if r in present]
    return raw.select(*cols)


class Staged(dict):
    """Staging models over a raw-table mapping, each built on first access."""

    def __init__(self, raw):
        super().__init__()
        self.raw = raw

    def __missing__(self, name: str) -> DataFrame:
        if name not in MODELS or SOURCE_OF[name] not in self.raw:
            raise KeyError(name)
        df = stage(name, self.raw[SOURCE_OF[name]])
        self[name] = df
        return df


def stage_all(raw) -> Staged:
    return Staged(raw)
