"""Summaries, limits, listings, hints and audits on the sample tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators import audit, reshape, topk
from musterroll.operators import summaries as S
from musterroll.operators.project import project
from musterroll.plans.catalog import column_profile
from musterroll.sources.tables import first_rows
from musterroll.specs.model import TABLE_ID_PATTERN
from musterroll.specs.tables import CUSTOMER, LINEITEM, ORDERS
from musterroll.workload.base import check, load
from musterroll.workload.filters import engine
from musterroll.workload.reshaping import flagged, lines


@check("""
    SELECT count(*) AS row_count, 'Units' AS unit,
           strftime(min(l_shipdate), '%Y-%m-%d') AS period_start, '2001' AS period_end,
           'LINEITEM' AS table_id, 'Order lines' AS table_name
    FROM lineitem
""")
def summary(spark: SparkSession, folder: str) -> DataFrame:
    row = S.summary(flagged(spark, folder), LINEITEM, end=2001)
    return row.select(
        "row_count", "unit", "period_start", "period_end", "table_id", "table_name"
    )


@check("""
    SELECT l_returnflag AS return_flag,
           CASE WHEN l_returnflag = 'R' THEN 'AUD' END AS unit, count(*) AS row_count
    FROM (
        SELECT l_returnflag FROM lineitem WHERE l_extendedprice IS NOT NULL
        UNION ALL
        SELECT l_returnflag FROM lineitem WHERE l_quantity IS NOT NULL AND l_returnflag <> 'R'
    ) GROUP BY 1, 2
""")
def common_unit(spark: SparkSession, folder: str) -> DataFrame:
    long = reshape.wide_flat(lines(spark, folder), LINEITEM, ["price", "quantity"])
    rows = long.select("return_flag", "measure", "unit").where(
        (F.col("measure") == "price") | (F.col("return_flag") != "R")
    )
    # count per unit first: the large aggregate then hashes, only a few rows are sorted
    counts = rows.groupBy("return_flag", "unit").agg(S.row_count().alias("n"))
    return counts.groupBy("return_flag").agg(
        S.common_unit(F.col("unit")).alias("unit"), F.sum("n").alias("row_count")
    )


@check("""
    SELECT strftime(min(l_shipdate), '%Y-%m-%d') AS first_period,
           strftime(max(l_shipdate), '%Y-%m-%d') AS last_period
    FROM lineitem
""")
def period_extent(spark: SparkSession, folder: str) -> DataFrame:
    first, last = S.period_extent(F.col("period"), None, None)
    return flagged(spark, folder).agg(first.alias("first_period"), last.alias("last_period"))


@check("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return S.distinct_values(load(spark, folder, "orders"), "o_orderpriority")


@check("""
    SELECT 2010 AS requested, CAST(min(year(o_orderdate)) AS INT) AS first_year,
           CAST(max(year(o_orderdate)) AS INT) AS last_year, FALSE AS found, 'AFTER' AS direction
    FROM orders
""")
def year_hint(spark: SparkSession, folder: str) -> DataFrame:
    years = load(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy").alias("y"))
    return S.year_hint(years, "y", 2010)


@check("""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS name, c_acctbal AS value,
           CASE WHEN (SELECT count(*) FROM customer) > 50
                THEN (SELECT count(*) FROM customer) END AS truncated_at
    FROM customer ORDER BY CAST(c_custkey AS VARCHAR), c_name LIMIT 50
""")
def latest_limit(spark: SparkSession, folder: str) -> DataFrame:
    page = engine(spark, folder).latest("CUSTOMER")
    return page.select(
        F.try_element_at("dimensions", F.lit("customer_key")).alias("customer_key"),
        F.try_element_at("dimensions", F.lit("name")).alias("name"),
        "value",
        "truncated_at",
    )


@check("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_extendedprice AS price
    FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100
""")
def top_n(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder).select("order_key", "line_number", "part_key", "price")
    top = topk.top_n(rows, "price", 100, ["order_key", "line_number", "part_key"])
    return top.select("order_key", "line_number", "price")


@check("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER () <= 1000
""")
def first_rows_guard(spark: SparkSession, folder: str) -> DataFrame:
    """A table asked for without a filter: its first rows in file order, no more."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return first_rows(spark, f"{folder.rstrip('/')}/lineitem.parquet", 1000).select(*keys)


@check("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity
    FROM lineitem ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey LIMIT 1000
""")
def top_n_two_step(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder).select("order_key", "line_number", "part_key", "quantity")
    top = topk.top_n(rows, "quantity", 1000, ["order_key", "line_number", "part_key"])
    return top.select("order_key", "line_number", "quantity")


@check("""
    SELECT DISTINCT upper(trim(p_brand || '_' || p_type)) AS id,
           regexp_full_match(upper(p_brand || '_' || p_type), '[A-Z][A-Z0-9_]*') AS valid
    FROM part
""")
def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of two halves of a table under one roof: normalised, once each, checked."""
    part = load(spark, folder, "part")
    small = part.where(F.col("p_size") < 25).select("p_brand", "p_type")
    rest = part.where(~(F.col("p_size") < 25)).select("p_type", "p_brand", "p_size")
    both = small.unionByName(rest, allowMissingColumns=True)
    ids = F.upper(F.trim(F.concat(F.lit(" "), F.concat_ws("_", F.lower("p_brand"), "p_type"))))
    return both.select(ids.alias("id")).distinct().select(
        "id", F.col("id").rlike(f"^{TABLE_ID_PATTERN}$").alias("valid")
    )


@check("""
    WITH seen AS (
        SELECT 'status' AS key, o_orderstatus AS code, count(*) AS n FROM orders GROUP BY ALL
        UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY ALL
    ), declared(key, code) AS (
        VALUES ('status', 'F'), ('status', 'O'), ('status', 'P'), ('status', 'R'),
               ('priority', '1-URGENT'), ('priority', '2-HIGH'), ('priority', '3-MEDIUM'),
               ('priority', '4-NOT SPECIFIED'), ('priority', '5-LOW')
    )
    SELECT coalesce(s.key, d.key) AS key, coalesce(s.code, d.code) AS code,
           coalesce(n, 0) AS rows,
           CASE WHEN d.key IS NULL THEN 'undeclared' WHEN n IS NULL THEN 'unseen'
                ELSE 'ok' END AS status
    FROM seen s FULL JOIN declared d ON s.key = d.key AND s.code = d.code
""")
def enum_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.enum_audit(project(load(spark, folder, "orders"), ORDERS), ORDERS)


@check("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, count(*) AS rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    short_key = dataclasses.replace(LINEITEM, natural_key=("order_key", "line_number"))
    return audit.duplicate_keys(lines(spark, folder), short_key)


@check("""
    SELECT 'register_name' AS key, TRUE AS constant, 'Customers' AS smallest FROM customer GROUP BY 1
    UNION ALL
    SELECT 'segment', min(c_mktsegment) = max(c_mktsegment), min(c_mktsegment) FROM customer
""")
def constant_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    named = rows.withColumn("register_name", F.lit("Customers"))
    return audit.constant_columns(named, ["register_name", "segment"])


@check("""
    SELECT key, role, unit, filled FROM (
        SELECT 'customer_key' AS key, 'id' AS role, NULL AS unit, count(c_custkey) AS filled
        FROM customer
        UNION ALL SELECT 'name', 'id', NULL, count(c_name) FROM customer
        UNION ALL SELECT 'nation_key', 'dimension', NULL, count(c_nationkey) FROM customer
        UNION ALL SELECT 'segment', 'dimension', NULL, count(c_mktsegment) FROM customer
        UNION ALL SELECT 'balance', 'measure', 'AUD', count(c_acctbal) FROM customer
    )
""")
def describe_profile(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    return column_profile(rows, CUSTOMER).select("key", "role", "unit", "filled")
