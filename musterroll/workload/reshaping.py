"""Wide and transposed reshapes, series, flat output, last N per measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators import reshape, topk
from musterroll.operators.project import project
from musterroll.specs.model import TableSpec, columns
from musterroll.specs.tables import CUSTOMER, LINEITEM
from musterroll.workload.base import check, load

_LONG = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           l_shipdate, measure, value,
           CASE measure WHEN 'quantity' THEN 'Count' WHEN 'price' THEN 'AUD'
                        ELSE 'Per cent' END AS unit
    FROM (
        SELECT *, 'quantity' AS measure, l_quantity AS value FROM lineitem
        UNION ALL SELECT *, 'price', l_extendedprice FROM lineitem
        UNION ALL SELECT *, 'discount', l_discount FROM lineitem
    ) WHERE value IS NOT NULL
"""


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return project(load(spark, folder, "lineitem"), LINEITEM)


@check(f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line_number,
           CAST(l_partkey AS VARCHAR) AS part_key, measure, value, unit
    FROM ({_LONG})
""")
def unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    flat = reshape.wide_flat(lines(spark, folder), LINEITEM)
    return flat.select("order_key", "line_number", "part_key", "measure", "value", "unit")


@check(f"""
    SELECT l_returnflag AS return_flag, l_linestatus AS line_status, measure, unit,
           count(*) AS n, round(sum(value), 2) AS total
    FROM ({_LONG}) WHERE measure IN ('price', 'discount')
    GROUP BY ALL
""")
def observations(spark: SparkSession, folder: str) -> DataFrame:
    long = reshape.wide_observations(lines(spark, folder), LINEITEM, ["l_extendedprice", "discount"])
    return long.groupBy(
        F.try_element_at("dimensions", F.lit("return_flag")).alias("return_flag"),
        F.try_element_at("dimensions", F.lit("line_status")).alias("line_status"),
        "measure",
        "unit",
    ).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@check("""
    SELECT key, name, value FROM (
        SELECT c_custkey AS key, 'nation_key' AS name, CAST(c_nationkey AS VARCHAR) AS value
        FROM customer
        UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, 'customer_key', CAST(c_custkey AS VARCHAR) FROM customer
        UNION ALL SELECT c_custkey, 'name', c_name FROM customer
    ) WHERE value IS NOT NULL
""")
def dimensions_explode(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    dims = reshape.dimension_map(CUSTOMER.dimension_keys)
    return rows.select(F.col("customer_key").alias("key"), F.explode(dims).alias("name", "value"))


@check("SELECT unnest(['nation_key', 'segment', 'customer_key', 'name']) AS name FROM customer GROUP BY 1")
def dimension_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    return reshape.dimension_names(reshape.wide_observations(rows, CUSTOMER))


@check("""
    SELECT 'balance' AS measure, c_acctbal AS value, 'AUD' AS unit,
           CAST(c_nationkey AS VARCHAR) AS nation_key, c_mktsegment AS segment,
           CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS name
    FROM customer
""")
def flat_output(spark: SparkSession, folder: str) -> DataFrame:
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    flat = reshape.flatten(reshape.wide_observations(rows, CUSTOMER), CUSTOMER.dimension_keys)
    return flat.drop("period")


# -- a metric-by-month table, made from lineitem -------------------------------

_MONTHLY = TableSpec(
    id="MONTHLY",
    name="Monthly quantity by return flag",
    layout="transposed",
    metric_label="Metric",
    unit_column="Unit",
    columns=columns("""
        metric  dimension  native  Metric
        unit    dimension  native  Unit
    """),
    enums={"metric": {"returned": "Flag R", "sent back": "Flag R", "accepted": "Flag A"}},
)
_OPEN = TableSpec(
    id="MONTHLY_OPEN",
    name="Monthly quantity, labels as they are",
    layout="transposed",
    metric_label="Metric",
    unit_column="Unit",
    columns=_MONTHLY.columns,
)


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    """One row per return flag, one column per month, labels padded as in real sheets."""
    lineitem = load(spark, folder, "lineitem")
    month = F.date_format("l_shipdate", "yyyy-MM")
    first, last = lineitem.agg(F.min("l_shipdate"), F.max("l_shipdate")).head()
    months = [
        f"{m // 12:04d}-{m % 12 + 1:02d}"
        for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    ]
    label = F.concat(F.lit(" Flag "), F.col("l_returnflag"), F.lit(" "))
    cells = lineitem.select(
        label.alias("Metric"), F.lit("Units").alias("Unit"), month.alias("month"), "l_quantity"
    )
    return cells.groupBy("Metric", "Unit").pivot("month", months).agg(F.sum("l_quantity"))


_BY_MONTH = """
    SELECT strftime(l_shipdate, '%Y-%m') AS period, 'Flag ' || l_returnflag AS label,
           sum(l_quantity) AS value
    FROM lineitem GROUP BY ALL
"""
_SHOWN = "CASE label WHEN 'Flag R' THEN 'sent back' WHEN 'Flag A' THEN 'accepted' ELSE label END"


def _with_label(long: DataFrame) -> DataFrame:
    label = F.try_element_at("dimensions", F.lit("metric_source_label"))
    return long.withColumn("source_label", label).drop("dimensions")


@check(f"""
    SELECT period, {_SHOWN} AS measure, value, 'Units' AS unit, label AS source_label
    FROM ({_BY_MONTH}) WHERE label IN ('Flag R', 'Flag A')
""")
def transposed(spark: SparkSession, folder: str) -> DataFrame:
    table = project(monthly(spark, folder), _MONTHLY)
    return _with_label(reshape.transposed_observations(table, _MONTHLY))


@check(f"""
    SELECT period, label AS measure, value, 'Units' AS unit, label AS source_label
    FROM ({_BY_MONTH})
""")
def transposed_all_labels(spark: SparkSession, folder: str) -> DataFrame:
    table = project(monthly(spark, folder), _OPEN)
    return _with_label(reshape.transposed_observations(table, _OPEN))


@check(f"""
    SELECT period, {_SHOWN} AS measure, value, 'Units' AS unit, label AS source_label
    FROM ({_BY_MONTH}) WHERE label = 'Flag R' AND period BETWEEN '1996-03' AND '1998-12'
""")
def transposed_range(spark: SparkSession, folder: str) -> DataFrame:
    table = project(monthly(spark, folder), _MONTHLY)
    return _with_label(
        reshape.transposed_observations(table, _MONTHLY, ["returned"], "1996-03", "1998")
    )


@check(f"""
    SELECT period, label AS measure, value, 'Units' AS unit, label AS source_label
    FROM ({_BY_MONTH})
    WHERE label IN (SELECT 'Flag ' || l_returnflag FROM lineitem
                    GROUP BY l_returnflag HAVING avg(l_discount) < 1 AND l_returnflag <> 'N')
""")
def transposed_label_table(spark: SparkSession, folder: str) -> DataFrame:
    """The wanted labels come from a table instead of a list."""
    table = project(monthly(spark, folder), _OPEN)
    flags = load(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.avg("l_discount").alias("d"))
    wanted = flags.where((F.col("d") < 1) & (F.col("l_returnflag") != "N")).select(
        F.concat(F.lit("Flag "), "l_returnflag").alias("label")
    )
    long = reshape.transposed_observations(table, _OPEN)
    return _with_label(reshape.with_labels(long, wanted, "label"))


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Long observations straight from the lines: period is the shipping day."""
    lineitem = load(spark, folder, "lineitem")
    return lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("period"),
        F.col("l_returnflag").alias("measure"),
        F.col("l_quantity").alias("value"),
        F.lit("Units").alias("unit"),
        F.create_map(
            F.lit("order"), F.col("l_orderkey").cast("string"),
            F.lit("line"), F.col("l_linenumber").cast("string"),
            F.lit("part"), F.col("l_partkey").cast("string"),
        ).alias("dimensions"),
    )


@check("""
    SELECT l_returnflag AS measure, 'Units' AS unit, count(*) AS n, sum(l_quantity) AS total,
           strftime(min(l_shipdate), '%Y-%m-%d') AS first_period,
           strftime(max(l_shipdate), '%Y-%m-%d') AS last_period,
           CAST(sum(l_orderkey) AS BIGINT) AS order_sum
    FROM lineitem GROUP BY 1
""")
def series(spark: SparkSession, folder: str) -> DataFrame:
    chunks = reshape.series(flagged(spark, folder), chunk_rows=5000)
    rows = F.col("observations")
    periods = F.transform(rows, lambda o: o["period"])
    orders = F.transform(
        rows, lambda o: F.try_element_at(o["dimensions"], F.lit("order")).cast("bigint")
    )
    per_chunk = chunks.select(
        "measure",
        "unit",
        "chunk",
        F.size(rows).cast("bigint").alias("n"),
        F.aggregate(rows, F.lit(0.0), lambda total, o: total + o["value"]).alias("total"),
        F.aggregate(orders, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("order_sum"),
        F.array_min(periods).alias("low"),
        F.array_max(periods).alias("high"),
    )
    return per_chunk.groupBy("measure", "unit").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("first_period"),
        F.max("high").alias("last_period"),
        F.sum("order_sum").alias("order_sum"),
    )


@check("""
    SELECT measure, period, value, order_key FROM (
        SELECT l_returnflag AS measure, strftime(l_shipdate, '%Y-%m-%d') AS period,
               l_quantity AS value, CAST(l_orderkey AS VARCHAR) AS order_key,
               row_number() OVER (
                   PARTITION BY l_returnflag
                   ORDER BY strftime(l_shipdate, '%Y-%m') DESC, l_shipdate DESC,
                            l_orderkey DESC, l_linenumber, l_partkey, l_quantity
               ) AS place
        FROM lineitem
    ) WHERE place <= 3
""")
def last_n_per_measure(spark: SparkSession, folder: str) -> DataFrame:
    def key(name: str):
        return F.try_element_at("dimensions", F.lit(name)).cast("bigint")

    newest = topk.last_n(
        flagged(spark, folder), 3,
        tiebreak=[key("order").desc(), key("line"), key("part"), F.col("value")],
        has_periods=True,
    )
    order = F.try_element_at("dimensions", F.lit("order")).alias("order_key")
    return newest.select("measure", "period", "value", order)


@check("""
    SELECT measure, period, count(*) AS n, sum(l_orderkey)::BIGINT AS orders FROM (
        SELECT l_returnflag AS measure, strftime(l_shipdate, '%Y-%m-%d') AS period, l_orderkey,
               row_number() OVER (
                   PARTITION BY l_returnflag
                   ORDER BY strftime(l_shipdate, '%Y-%m') DESC, l_shipdate DESC,
                            l_orderkey DESC, l_linenumber, l_partkey, l_quantity
               ) AS place
        FROM lineitem
    ) WHERE place <= 12000 GROUP BY ALL
""")
def last_n_many(spark: SparkSession, folder: str) -> DataFrame:
    """More rows per measure than tasks can cut to: found by counts per period."""

    def key(name: str):
        return F.try_element_at("dimensions", F.lit(name)).cast("bigint")

    newest = topk.last_n(
        flagged(spark, folder), 12_000,
        tiebreak=[key("order").desc(), key("line"), key("part"), F.col("value")],
        has_periods=True,
    )
    return newest.groupBy("measure", "period").agg(F.count("*").alias("n"), F.sum(key("order")).alias("orders"))


@check("""
    SELECT 'balance' AS measure, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
""")
def last_n_without_periods(spark: SparkSession, folder: str) -> DataFrame:
    """A wide table has no periods: nothing is cut, whatever N is."""
    rows = project(load(spark, folder, "customer"), CUSTOMER)
    kept = topk.last_n(reshape.wide_observations(rows, CUSTOMER), 1)
    return kept.groupBy("measure").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@check("""
    WITH held AS (
        SELECT o_orderkey, list_filter([
            {'k': 'urgent', 'v': CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END},
            {'k': 'status', 'v': CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END},
            {'k': 'low', 'v': CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority END}], lambda x: x.v IS NOT NULL) AS dims
        FROM orders
    ), cells AS (SELECT o_orderkey, unnest(range(len(dims))) AS place, dims FROM held),
    header AS (
        SELECT list(k ORDER BY o_orderkey, place) AS names FROM (
            SELECT dims[place + 1].k AS k, o_orderkey, place FROM cells
            QUALIFY row_number() OVER (PARTITION BY dims[place + 1].k ORDER BY o_orderkey, place) = 1)
    )
    SELECT concat_ws(',', 'order', o_orderkey, array_to_string(list_transform(names,
               lambda n: coalesce(list_filter(dims, lambda x: x.k = n)[1].v, '')), ',')) AS line
    FROM held, header
""")
def csv_as_seen(spark: SparkSession, folder: str) -> DataFrame:
    """CSV lines whose dimension columns stand as the rows first have them; many rows lack some."""
    orders = load(spark, folder, "orders")
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    dims = F.create_map(
        F.lit("urgent"), F.when(urgent, F.col("o_orderpriority")),
        F.lit("status"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")),
        F.lit("low"), F.when(low, F.col("o_orderpriority")),
    )
    long = orders.select(
        F.lit(None).cast("string").alias("period"), F.lit("order").alias("measure"), F.col("o_orderkey").alias("value"),
        F.lit(None).cast("string").alias("unit"), F.map_filter(dims, lambda _, v: v.isNotNull()).alias("dimensions"),
    )
    flat = reshape.flatten_as_seen(long, F.col("value"))
    return reshape.csv_lines(flat.drop("period", "unit"))
