"""Specs over the TPC-H-like sample tables, used by the checked queries."""

from __future__ import annotations

from musterroll.specs.model import TableSpec, columns

ORDERS = TableSpec(
    id="ORDERS",
    name="Customer orders",
    keywords=("orders", "purchases"),
    natural_key=("order_key",),
    columns=columns("""
        order_key     id         native  o_orderkey
        customer_key  id         native  o_custkey
        status        dimension  native  o_orderstatus
        priority      dimension  native  o_orderpriority
        order_date    dimension  native  o_orderdate
        total_price   measure    double  o_totalprice  AUD
    """),
    enums={
        "status": {
            "filled": "F", "closed": "F", "open": "O", "pending": "P", "returned": "R",
            "F": "F", "O": "O", "P": "P",
        },
        "priority": {
            "urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "low": "5-LOW",
            "1-URGENT": "1-URGENT", "2-HIGH": "2-HIGH", "3-MEDIUM": "3-MEDIUM",
            "4-NOT SPECIFIED": "4-NOT SPECIFIED", "5-LOW": "5-LOW",
        },
    },
)

CUSTOMER = TableSpec(
    id="CUSTOMER",
    name="Customers",
    keywords=("customers", "accounts"),
    natural_key=("customer_key",),
    columns=columns("""
        customer_key  id         native  c_custkey
        name          id         string  c_name
        nation_key    dimension  native  c_nationkey
        segment       dimension  string  c_mktsegment
        balance       measure    double  c_acctbal  AUD
    """),
)

PART = TableSpec(
    id="PART",
    name="Parts",
    keywords=("parts", "products"),
    natural_key=("part_key",),
    columns=columns("""
        part_key  id         native  p_partkey
        name      dimension  native  p_name
        brand     dimension  native  p_brand
        type      dimension  native  p_type
        size      measure    long    p_size         Count
        price     measure    double  p_retailprice  AUD
    """),
)

LINEITEM = TableSpec(
    id="LINEITEM",
    name="Order lines",
    keywords=("order lines", "sales"),
    natural_key=("order_key", "line_number", "part_key", "supplier_key"),
    large=True,
    columns=columns("""
        order_key      id         native  l_orderkey
        line_number    id         native  l_linenumber
        part_key       id         native  l_partkey
        supplier_key   id         native  l_suppkey
        return_flag    dimension  native  l_returnflag
        line_status    dimension  native  l_linestatus
        ship_date      dimension  native  l_shipdate
        quantity       measure    double  l_quantity       Count
        price          measure    double  l_extendedprice  AUD
        discount       measure    double  l_discount       Per cent
    """),
    enums={
        "return_flag": {"accepted": "A", "none": "N", "returned": "R", "A": "A", "N": "N", "R": "R"},
        "line_status": {"open": "O", "filled": "F", "O": "O", "F": "F"},
    },
)

DOCUMENTS = TableSpec(
    id="DOCUMENTS",
    name="Documents",
    keywords=("documents", "texts"),
    natural_key=("doc_id",),
    truncate={"text": 200},
    columns=columns("""
        doc_id   id         native  doc_id
        text     dimension  native  text
        lang     dimension  native  lang
        source   dimension  native  source
        n_chars  measure    long    n_chars  Count
    """),
)

SAMPLE_TABLES = (ORDERS, CUSTOMER, PART, LINEITEM, DOCUMENTS)
