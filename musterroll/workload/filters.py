"""Friendly filters, date and period ranges, blank rows on the sample tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.functions.periods import normalize_period, period_in_range
from musterroll.operators import filters as flt
from musterroll.operators import reshape
from musterroll.operators.project import project
from musterroll.plans.engine import Engine
from musterroll.specs.model import Catalog
from musterroll.specs.tables import CUSTOMER, LINEITEM, ORDERS, SAMPLE_TABLES
from musterroll.workload.base import check, load


def engine(spark: SparkSession, folder: str) -> Engine:
    out = Engine(spark, Catalog(SAMPLE_TABLES))
    for spec in SAMPLE_TABLES:
        out.bind(spec.id, f"{folder.rstrip('/')}/{spec.id.lower()}.parquet")
    return out


_ORDER = """
    SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS status,
           o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           o_totalprice AS total_price
    FROM orders
"""


def _dated(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@check(_ORDER + "WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_and(spark: SparkSession, folder: str) -> DataFrame:
    filters = {"status": "filled", "priority": ["urgent", "2-HIGH"]}
    return _dated(engine(spark, folder).rows("ORDERS", filters))


@check(_ORDER + "WHERE o_orderstatus = 'O'")
def filter_enum(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(engine(spark, folder).rows("orders", {"status": " open "}))


@check(_ORDER + "WHERE o_orderpriority IN ('3-MEDIUM', '5-LOW')")
def filter_list(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(engine(spark, folder).rows("ORDERS", {"priority": ["medium", "low"]}))


@check(_ORDER + "WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
def filter_json(spark: SparkSession, folder: str) -> DataFrame:
    filters = '{"status": "P", "priority": ["urgent"]}'
    return _dated(engine(spark, folder).rows("ORDERS", filters))


_PART = """
    SELECT p_partkey AS part_key, p_name AS name, p_brand AS brand, p_type AS type,
           CAST(p_size AS BIGINT) AS size, p_retailprice AS price
    FROM part
"""


@check(_PART + "WHERE contains(lower(p_name), 'widget')")
def filter_contains(spark: SparkSession, folder: str) -> DataFrame:
    return engine(spark, folder).rows("PART", {"name": "WIDGET"})


@check(_PART + "WHERE contains(lower(p_name), 'blue') AND contains(lower(p_brand), '#1')")
def filter_wildcard(spark: SparkSession, folder: str) -> DataFrame:
    return engine(spark, folder).rows("PART", {"name": "*bLuE~", "brand": "#1*"})


@check("""
    SELECT c_custkey AS customer_key, c_name AS name, c_acctbal AS balance
    FROM customer WHERE contains(CAST(c_custkey AS VARCHAR), '7')
""")
def filter_id_substring(spark: SparkSession, folder: str) -> DataFrame:
    rows = engine(spark, folder).rows("CUSTOMER", {"customer_key": 7})
    return rows.select("customer_key", "name", "balance")


@check("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def filter_column(spark: SparkSession, folder: str) -> DataFrame:
    parsed = flt.parse_filter_column(F.col("props"))
    return load(spark, folder, "events").select(
        "event_id", F.try_element_at(parsed, F.lit("k")).alias("k")
    )


def _with_blanks(spark: SparkSession, folder: str) -> DataFrame:
    """Customers that lose their nation when in debt and their segment below 2000."""
    customers = project(load(spark, folder, "customer"), CUSTOMER)
    return customers.withColumns({
        "nation_key": F.when(F.col("balance") >= 0, F.col("nation_key")),
        "segment": F.when(F.col("balance") >= 2000, F.col("segment")),
    })


_BLANKS = """
    SELECT c_custkey AS customer_key, c_name AS name,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation_key,
           CASE WHEN c_acctbal >= 2000 THEN c_mktsegment END AS segment
    FROM customer
"""


@check(f"SELECT * FROM ({_BLANKS}) WHERE NOT (nation_key IS NULL AND segment IS NULL)")
def blank_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = flt.drop_blank_rows(_with_blanks(spark, folder), ["nation_key", "segment", "absent"])
    return rows.select("customer_key", "name", "nation_key", "segment")


@check(f"""
    SELECT CAST(nation_key AS VARCHAR) AS nation_key, segment, count(*) AS n_rows
    FROM ({_BLANKS}) WHERE NOT (nation_key IS NULL AND segment IS NULL)
    GROUP BY ALL
""")
def empty_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    dims = reshape.dimension_map(["nation_key", "segment"])
    rows = _with_blanks(spark, folder).select(dims.alias("dimensions"))
    kept = flt.drop_empty_dimensions(rows)
    return kept.groupBy(
        F.try_element_at("dimensions", F.lit("nation_key")).alias("nation_key"),
        F.try_element_at("dimensions", F.lit("segment")).alias("segment"),
    ).agg(F.count("*").alias("n_rows"))


@check("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_date
    FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-07-01'
""")
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = engine(spark, folder).rows(
        "LINEITEM", start_period=1996, end_period="1997-06", date_column="ship_date"
    )
    return rows.select(
        "order_key", "line_number", "part_key",
        F.date_format("ship_date", "yyyy-MM-dd").alias("ship_date"),
    )


@check("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders
    WHERE o_orderpriority <> '5-LOW'
      AND o_orderdate >= DATE '1999-11-15' AND o_orderdate < DATE '2001-01-01'
""")
def date_range_text(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("o_orderpriority") == "5-LOW", "Permanent banning").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    orders = load(spark, folder, "orders").select("o_orderkey", text.alias("order_date"))
    kept = flt.date_range(orders, "order_date", "1999-11-15", "2000")
    return kept.select(
        "o_orderkey",
        F.date_format(F.to_date("order_date", "dd/MM/yyyy"), "yyyy-MM-dd").alias("order_date"),
    )


def _period(day: Column, kind: Column) -> Column:
    """A period text in the form that goes with an order's priority."""
    year = F.date_format(day, "yyyy")
    next_year = F.lpad((F.year(day) % 100 + 1).cast("string"), 2, "0")
    return (
        F.when(kind == "1-URGENT", F.concat(F.lit(" "), year, F.lit(" ")))
        .when(kind == "2-HIGH", F.concat(year, F.lit("-"), next_year))
        .when(kind == "3-MEDIUM", F.date_format(day, "yyyy-MM"))
        .when(kind == "4-NOT SPECIFIED", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise("year to date")
    )


_PERIOD = """
    SELECT o_orderkey, CASE o_orderpriority
             WHEN '1-URGENT' THEN ' ' || strftime(o_orderdate, '%Y') || ' '
             WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y') || '-'
                  || lpad(CAST(year(o_orderdate) % 100 + 1 AS VARCHAR), 2, '0')
             WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m')
             WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
             ELSE 'year to date' END AS period
    FROM orders
"""
_NORMAL = f"""
    SELECT o_orderkey, period,
           CASE WHEN regexp_full_match(trim(period), '[0-9]{{4}}-[0-9]{{2}}') THEN
                  CASE WHEN trim(period)[6:7] = '00' THEN NULL
                       WHEN trim(period)[6:7] <= '12' THEN trim(period)
                       ELSE trim(period)[1:4] END
                WHEN length(trim(period)) >= 10 AND trim(period)[5:5] = '-'
                     AND trim(period)[8:8] = '-' THEN trim(period)[1:7]
                WHEN regexp_full_match(trim(period), '[0-9]{{4}}') THEN trim(period) END AS month
    FROM ({_PERIOD})
"""


def _periods(spark: SparkSession, folder: str) -> DataFrame:
    period = _period(F.col("o_orderdate"), F.col("o_orderpriority"))
    return load(spark, folder, "orders").select("o_orderkey", period.alias("period"))


@check(f"SELECT o_orderkey, period, month FROM ({_NORMAL})")
def period_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _periods(spark, folder).withColumn("month", normalize_period(F.col("period")))


@check(f"""
    SELECT o_orderkey, period FROM ({_NORMAL})
    WHERE month IS NULL
       OR (month >= '1996-03'
           AND month <= CASE WHEN length(month) > 4 THEN '1998-99' ELSE '1998' END)
""")
def period_range(spark: SparkSession, folder: str) -> DataFrame:
    return _periods(spark, folder).where(period_in_range(F.col("period"), "1996-03", "1998"))


@check("""
    SELECT l_returnflag AS return_flag, l_linestatus AS line_status, count(*) AS n_rows
    FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' GROUP BY ALL
""")
def filter_then_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "lineitem"), LINEITEM)
    kept = flt.apply_filters(rows, LINEITEM, {"return_flag": "returned", "line_status": "open"})
    return kept.groupBy("return_flag", "line_status").agg(F.count("*").alias("n_rows"))



@check("""
    SELECT CAST(NULL AS VARCHAR) AS period, 'total_price' AS measure, o_totalprice AS value,
           'AUD' AS unit, o_orderstatus AS status, o_orderpriority AS priority,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date,
           CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS customer_key
    FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def query_flat(spark: SparkSession, folder: str) -> DataFrame:
    return engine(spark, folder).query("ORDERS", {"priority": "urgent"}, format="csv")


@check("""
    SELECT 'balance' AS measure, 'AUD' AS unit, count(*) AS n, count(DISTINCT c_custkey) AS n_keys
    FROM customer WHERE contains(lower(c_mktsegment), 'build')
""")
def query_series(spark: SparkSession, folder: str) -> DataFrame:
    series = engine(spark, folder).query("CUSTOMER", {"segment": "build"}, format="series")
    keys = F.transform(
        "observations", lambda o: F.try_element_at(o["dimensions"], F.lit("customer_key"))
    )
    sizes = series.select(
        "measure",
        "unit",
        F.size("observations").cast("bigint").alias("n"),
        F.size(F.array_distinct(keys)).cast("bigint").alias("n_keys"),
    )
    return sizes.groupBy("measure", "unit").agg(
        F.sum("n").alias("n"), F.sum("n_keys").alias("n_keys")
    )


@check("""
    SELECT 'LINEITEM' AS table_id, count(l_quantity) + count(l_extendedprice) + count(l_discount)
               AS row_count,
           CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS period_start,
           '{"filters": {"return_flag": "returned"}}' AS query
    FROM lineitem WHERE l_returnflag = 'R'
""")
def query_summary(spark: SparkSession, folder: str) -> DataFrame:
    row = engine(spark, folder).summary("LINEITEM", filters={"return_flag": "returned"})
    return row.select("table_id", "row_count", "unit", "period_start", "query")


@check("""
    SELECT doc_id, lang,
           CASE WHEN length(text) > 200 THEN substr(text, 1, 200)
                || '...[cut here; leave out cut_text to see the full text]'
                ELSE text END AS text
    FROM documents WHERE contains(lower(text), 'the') AND lang IN ('en', 'de')
""")
def query_long_text(spark: SparkSession, folder: str) -> DataFrame:
    """The filter sees the whole text, the result shows its beginning."""
    rows = engine(spark, folder).rows(
        "DOCUMENTS", {"text": "THE*", "lang": ["en", "de"]}, cut_text=200
    )
    return rows.select("doc_id", "lang", "text")


@check("""
    SELECT 'quantity' AS measure, count(l_quantity) AS n, round(sum(l_quantity), 2) AS total FROM lineitem
    UNION ALL SELECT 'price', count(l_extendedprice), round(sum(l_extendedprice), 2) FROM lineitem
    UNION ALL SELECT 'discount', count(l_discount), round(sum(l_discount), 2) FROM lineitem
""")
def query_unfiltered(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing narrows the query of a large table: every row counts."""
    rows = engine(spark, folder).query("LINEITEM")
    return rows.groupBy("measure").agg(
        F.count("value").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@check("""
    SELECT 'ORDERS' AS table_id, count(*) AS row_count, TRUE AS stale,
           'weekly snapshot is 31 days old, expected at most 14' AS stale_reason
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL
""")
def query_stale(spark: SparkSession, folder: str) -> DataFrame:
    """The answer says that its snapshot is older than the table's cadence allows."""
    weekly = dataclasses.replace(ORDERS, cadence="weekly")
    bound = Engine(spark, Catalog([weekly])).bind("ORDERS", load(spark, folder, "orders"))
    row = bound.summary(
        "ORDERS", as_of="2024-02-01", snapshot_date="2024-01-01", filters={"status": "filled"}
    )
    return row.select("table_id", "row_count", "stale", "stale_reason")
