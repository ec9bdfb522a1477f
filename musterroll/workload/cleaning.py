"""Projection and cleaning on the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.functions import cleaning as C
from musterroll.functions.regions import normalize_region
from musterroll.operators.project import coercion_report, project
from musterroll.specs.model import TableSpec, columns
from musterroll.specs.registers import TRUNCATION_CHARS, TRUNCATION_SUFFIX
from musterroll.specs.tables import CUSTOMER
from musterroll.workload.base import check, load


@check("""
    SELECT c_custkey AS customer_key, c_name AS name, c_nationkey AS nation_key,
           c_mktsegment AS segment, c_acctbal AS balance
    FROM customer
""")
def alias_project(spark: SparkSession, folder: str) -> DataFrame:
    return project(load(spark, folder, "customer"), CUSTOMER)


@check("""
    SELECT p_partkey, p_name AS clean,
           replace(p_name, ' ', chr(160)) AS inner_kept,
           p_brand || ' ' || p_name AS collapsed
    FROM part
""")
def clean_string(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part")
    nbsp = F.lit("\u00a0")
    padded = F.concat(nbsp, F.lit(" "), nbsp, F.col("p_name"), F.lit(" \t"), nbsp)
    inner = F.concat(nbsp, F.replace(F.col("p_name"), F.lit(" "), nbsp))
    spaced = F.concat(F.col("p_brand"), nbsp, F.lit("  "), F.col("p_name"), nbsp)
    return part.select(
        "p_partkey",
        C.clean_string(padded).alias("clean"),
        C.clean_string(inner).alias("inner_kept"),
        C.collapse_spaces(spaced).alias("collapsed"),
    )


@check("""
    SELECT p_partkey,
           CASE WHEN p_size < 15 THEN NULL ELSE p_type END AS part_type
    FROM part
""")
def null_sentinels(spark: SparkSession, folder: str) -> DataFrame:
    raw = (
        F.when(F.col("p_size") < 5, "NULL")
        .when(F.col("p_size") < 10, "")
        .when(F.col("p_size") < 15, "null")
        .otherwise(F.col("p_type"))
    )
    return load(spark, folder, "part").select(
        "p_partkey", C.null_tokens(raw).alias("part_type")
    )


_PROP_TEXT = """
    SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events
"""


def _prop_text() -> Column:
    """The number in ``props`` as text, spoiled in ways that depend on the event type."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return (
        F.when(kind == "error", F.concat(k, F.lit("x")))
        .when(kind == "view", F.concat(k, F.lit(".5")))
        .when(kind == "click", F.concat(F.lit(" "), k, F.lit(".0 ")))
        .when(kind == "signup", "nan")
        .otherwise(k)
    )


@check(f"""
    SELECT event_id,
           CASE WHEN event_type IN ('click', 'purchase') THEN k::BIGINT END AS as_long,
           CASE WHEN event_type IN ('click', 'purchase') THEN k::DOUBLE
                WHEN event_type = 'view' THEN k::DOUBLE + 0.5 END AS as_double,
           event_type IN ('error', 'signup') AS failed
    FROM ({_PROP_TEXT})
""")
def numeric_coerce(spark: SparkSession, folder: str) -> DataFrame:
    text = _prop_text()
    number = C.to_double(text)
    return load(spark, folder, "events").select(
        "event_id",
        C.to_long(text).alias("as_long"),
        number.alias("as_double"),
        C.coercion_failed(text, number).alias("failed"),
    )


_PROPS = TableSpec(
    id="PROPS",
    name="Event properties",
    columns=columns("""
        event_id  id       native  event_id
        whole     measure  long    k_text
        number    measure  double  k_again
    """),
)


@check(f"""
    SELECT 'whole' AS key, count(k) AS filled,
           count(*) FILTER (event_type IN ('error', 'view', 'signup')) AS failed
    FROM ({_PROP_TEXT})
    UNION ALL
    SELECT 'number', count(k), count(*) FILTER (event_type IN ('error', 'signup'))
    FROM ({_PROP_TEXT})
""")
def coercion_quality(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").select(
        "event_id", _prop_text().alias("k_text"), _prop_text().alias("k_again")
    )
    return coercion_report(events, _PROPS)


@check("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Permanent banning'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                ELSE CAST(year(o_orderdate) AS INT) END AS order_year
    FROM orders
""")
def date_iso(spark: SparkSession, folder: str) -> DataFrame:
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when((status == "P") & (F.col("o_orderpriority") == "5-LOW"), "Permanent banning")
        .when(status == "F", F.date_format(day, "dd/MM/yyyy"))
        .when(status == "O", F.date_format(day, "d/M/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return load(spark, folder, "orders").select(
        "o_orderkey",
        C.date_to_iso(text).alias("order_date"),
        F.year(C.parse_date(text)).alias("order_year"),
    )


@check("""
    SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key,
           CAST(c_nationkey AS VARCHAR) AS whole_text
    FROM customer
""")
def key_normalize(spark: SparkSession, folder: str) -> DataFrame:
    digits = F.element_at(F.split("c_name", "#"), 2)
    return load(spark, folder, "customer").select(
        "c_custkey",
        C.normalize_key(digits).alias("key"),
        C.whole_number_text(F.col("c_nationkey").cast("double")).alias("whole_text"),
    )


@check(f"""
    SELECT doc_id,
           CASE WHEN length(text) > {TRUNCATION_CHARS}
                THEN substr(text, 1, {TRUNCATION_CHARS}) || '{TRUNCATION_SUFFIX}'
                ELSE text END AS text
    FROM documents
""")
def truncate_long_text(spark: SparkSession, folder: str) -> DataFrame:
    text = C.truncate_text(F.col("text"), TRUNCATION_CHARS, TRUNCATION_SUFFIX)
    return load(spark, folder, "documents").select("doc_id", text.alias("text"))


@check("""
    WITH written AS (
        SELECT c_custkey, c_mktsegment AS form, CAST(floor(abs(c_acctbal)) AS INT) AS number
        FROM customer
    )
    SELECT c_custkey,
           CASE form
             WHEN 'BUILDING' THEN 'NSW' WHEN 'HOUSEHOLD' THEN 'QLD' WHEN 'MACHINERY' THEN 'TAS'
             WHEN 'FURNITURE' THEN NULL
             ELSE CASE
               WHEN number BETWEEN 200 AND 299 OR number BETWEEN 2600 AND 2618
                    OR number BETWEEN 2900 AND 2920 THEN 'ACT'
               WHEN number BETWEEN 800 AND 999 THEN 'NT'
               WHEN number BETWEEN 1000 AND 2999 THEN 'NSW'
               WHEN number BETWEEN 3000 AND 3999 OR number BETWEEN 8000 AND 8999 THEN 'VIC'
               WHEN number BETWEEN 4000 AND 4999 OR number BETWEEN 9000 AND 9999 THEN 'QLD'
               WHEN number BETWEEN 5000 AND 5999 THEN 'SA'
               WHEN number BETWEEN 6000 AND 6797 OR number BETWEEN 6800 AND 6999 THEN 'WA'
               WHEN number BETWEEN 7000 AND 7999 THEN 'TAS' END
           END AS state
    FROM written
""")
def region_normalize(spark: SparkSession, folder: str) -> DataFrame:
    form = F.col("c_mktsegment")
    postcode = F.lpad(F.floor(F.abs("c_acctbal")).cast("string"), 4, "0")
    text = (
        F.when(form == "BUILDING", " new South Wales ")
        .when(form == "HOUSEHOLD", "au-qld")
        .when(form == "MACHINERY", "Tassie")
        .when(form == "FURNITURE", F.col("c_name"))
        .otherwise(postcode)
    )
    return load(spark, folder, "customer").select(
        "c_custkey", normalize_region(text).alias("state")
    )


@check("""
    SELECT l_orderkey, l_linenumber, written,
           CASE WHEN written LIKE '%.0' THEN CAST(l_quantity AS BIGINT) END AS as_long
    FROM (SELECT l_orderkey, l_linenumber, l_quantity,
                 CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
                 || CASE WHEN l_linenumber % 2 = 0 THEN '.0' ELSE '.0000000001' END AS written
          FROM lineitem)
""")
def coerce_exact(spark: SparkSession, folder: str) -> DataFrame:
    """A fraction beyond any rounding is still a fraction."""
    tail = F.when(F.col("l_linenumber") % 2 == 0, ".0").otherwise(".0000000001")
    text = F.concat(F.col("l_quantity").cast("bigint").cast("string"), tail)
    lines = load(spark, folder, "lineitem").withColumn("written", text)
    return lines.select("l_orderkey", "l_linenumber", "written", C.to_long(F.col("written")).alias("as_long"))
