"""Enrichment and membership joins on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators import joins as J
from musterroll.workload.base import check, load


@check("""
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def enrich_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    # one side writes its keys with leading zeros, the other as plain numbers
    padded = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    customers = load(spark, folder, "customer").withColumn("account", padded)
    joined = J.enrich(orders, customers, "o_custkey", "account", ["c_name", "c_mktsegment"])
    return joined.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@check("""
    SELECT l_returnflag, n_name, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY ALL
""")
def enrich_chain(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    supplier = load(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, folder, "nation").select("n_nationkey", "n_name")
    # pre-aggregate by the join key: far fewer rows meet the joins than were read,
    # and no key can be hot any more
    sums = lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("q")
    )
    named = J.join_on_key(
        supplier, nation, "s_nationkey", "n_nationkey", "inner", normalize=False
    )
    joined = J.join_on_key(sums, named, "l_suppkey", "s_suppkey", "inner")
    return joined.groupBy("l_returnflag", "n_name").agg(
        F.sum("n").alias("n_lines"), F.round(F.sum("q"), 2).alias("quantity")
    )


@check("""
    SELECT event_id, flag, n_name FROM (
        SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                              ELSE least(user_id, 7) END AS flag
        FROM events)
    LEFT JOIN nation ON flag = n_nationkey
""")
def enrich_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """One key holds most rows and another fifth has none: both are spread."""
    flag = F.when(F.col("event_type") != "error", F.least("user_id", F.lit(7).cast("bigint")))
    events = load(spark, folder, "events").select("event_id", flag.alias("flag"))
    nation = load(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = J.join_on_key(events, nation, "flag", "n_nationkey", "left")
    return joined.select("event_id", "flag", "n_name")


@check("""
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")
def listed(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return J.listed(load(spark, folder, "customer"), orders, "c_custkey", "o_custkey").select(
        "c_custkey", "c_name"
    )


@check("""
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")
def unlisted(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return J.unlisted(load(spark, folder, "customer"), orders, "c_custkey", "o_custkey").select(
        "c_custkey", "c_name"
    )


@check("""
    SELECT o_orderkey, o_custkey, best AS c_name FROM orders
    LEFT JOIN (SELECT c_nationkey, min(c_name) AS best FROM customer GROUP BY c_nationkey)
        ON o_custkey % 25 = c_nationkey
""")
def enrich_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The right side has every key many times: left rows do not multiply."""
    nation = (F.col("o_custkey") % 25).alias("nation")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", nation)
    joined = J.enrich(orders, load(spark, folder, "customer"), "nation", "c_nationkey", ["c_name"])
    return joined.select("o_orderkey", "o_custkey", "c_name")
