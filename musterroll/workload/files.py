"""Files written from the sample tables and read back through the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators.project import project
from musterroll.plans.engine import Engine
from musterroll.sources import delimited as D
from musterroll.sources.carve import carve
from musterroll.sources.signatures import file_changes as changes_of
from musterroll.sources.signatures import file_signatures
from musterroll.sources.tables import (
    materialise,
    materialise_many,
    read_table,
    scratch_path,
    write_csv,
    write_parquet,
)
from musterroll.specs.model import Catalog, TableSpec, columns
from musterroll.specs.tables import CUSTOMER, LINEITEM, ORDERS, PART
from musterroll.streaming.incremental import daily_files, load_new_files
from musterroll.streaming.keyed import load_latest, read_latest
from musterroll.workload.base import check, load

# Characters that both single-byte encodings write the same way.
SINGLE_BYTE = r"^[\x00-\x7F\xA0-\xFF]*$"


@check("SELECT doc_id, text, lang, n_chars FROM documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with line breaks and quotes through quoted CSV and back."""
    documents = load(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    path = scratch_path(spark, "csv")
    write_csv(documents, path)
    back = D.read_delimited(spark, path, encoding="utf-8", drop_null_tokens=False)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang",
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )


@check("SELECT p_partkey, p_name, p_brand, CASE WHEN p_size < 25 THEN p_type END AS p_type FROM part")
def mixed_delimiters(spark: SparkSession, folder: str) -> DataFrame:
    """Comma and tab files of one register, one group with a column less."""
    part = load(spark, folder, "part")
    base = scratch_path(spark, "mixed")
    write_csv(
        part.where(F.col("p_size") < 25).select("p_partkey", "p_name", "p_brand", "p_type"),
        f"{base}/a",
    )
    write_csv(
        part.where(~(F.col("p_size") < 25)).select("p_brand", "p_name", "p_partkey"),
        f"{base}/b", delimiter="\t",
    )
    back = D.read_delimited(spark, [f"{base}/a", f"{base}/b"], multiline=False)
    return back.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand", "p_type"
    )


@check("SELECT doc_id, text FROM documents")
def mixed_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in single-byte files where they fit and in UTF-8 files otherwise."""
    documents = load(spark, folder, "documents").select("doc_id", "text")
    base = scratch_path(spark, "encodings")
    fits = F.col("text").rlike("(?s)" + SINGLE_BYTE)
    write_csv(documents.where(fits), f"{base}/a", encoding="ISO-8859-1")
    write_csv(documents.where(~fits), f"{base}/b")
    back = D.read_delimited(spark, [f"{base}/a", f"{base}/b"], drop_null_tokens=False)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


@check("""
    SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand FROM part
    WHERE p_partkey >= 4 AND p_partkey < 1004
""")
def carve_out(spark: SparkSession, folder: str) -> DataFrame:
    """Header in row 1, spacer rows to row 4, a thousand data rows, the rest a footnote."""
    part = load(spark, folder, "part")
    cells = [F.col(c).cast("string").alias(c) for c in ("p_partkey", "p_name", "p_brand")]
    grid = part.select(*cells, (F.col("_metadata.row_index") + 1).alias("_row"))
    sheet = carve(grid, header_row=1, data_start_row=5, max_rows=1000)
    return sheet.toDF("key", "name", "brand")


@check("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_extendedprice AS price
    FROM lineitem WHERE l_returnflag = 'R'
""")
def materialised_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A table converted once; the filter then reaches the Parquet scan."""
    path = scratch_path(spark, "lineitem")
    materialise(load(spark, folder, "lineitem"), path, spec=LINEITEM)
    table = project(read_table(spark, path), LINEITEM.materialised())
    return table.where(F.col("return_flag") == "R").select("order_key", "line_number", "price")


@check("""
    SELECT c_custkey AS customer_key, c_name AS name, c_acctbal AS balance
    FROM customer WHERE contains(lower(c_name), 'r#00000012')
""")
def filter_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """A substring looked up in a trigram index; other blocks of the table are not read."""
    path = scratch_path(spark, "customer")
    materialise(
        load(spark, folder, "customer"), path, spec=CUSTOMER, cluster_by=["name"], text_index=["name"], block_rows=16
    )
    engine = Engine(spark, Catalog([CUSTOMER])).bind("CUSTOMER", path, materialised=True)
    return engine.rows("CUSTOMER", {"name": "*R#00000012*"}).select("customer_key", "name", "balance")


@check("""
    SELECT 'CUSTOMER' AS id, 'ok' AS status, count(*) AS rows FROM customer
    UNION ALL SELECT 'ORDERS', 'ok', count(*) FROM orders
    UNION ALL SELECT 'PART', 'ok', count(*) FROM part
    UNION ALL SELECT 'PART_EMPTY', 'error', NULL FROM part GROUP BY 1
""")
def materialise_status(spark: SparkSession, folder: str) -> DataFrame:
    empty = TableSpec(id="PART_EMPTY", name="No parts", columns=PART.columns)
    base = scratch_path(spark, "registers")

    def source(spec: TableSpec) -> DataFrame:
        if spec.id == "PART_EMPTY":
            return load(spark, folder, "part").where(F.col("p_size") < 0)
        return load(spark, folder, spec.id.lower())

    status = materialise_many(
        spark, Catalog([CUSTOMER, ORDERS, PART, empty]), source, lambda s: f"{base}/{s.id.lower()}"
    )
    return status.withColumn("status", F.element_at(F.split("status", ":"), 1))


_EVENTS = TableSpec(
    id="EVENTS",
    name="Events by day",
    columns=columns("""
        event_id    id         string  event_id
        user_id     id         string  user_id
        event_type  dimension  string  event_type
        value       measure    double  value
    """),
)
_BY_DAY = """
    SELECT strftime(ts, '%Y-%m-%d') AS file_date, CAST(event_id AS VARCHAR) AS event_id,
           CAST(user_id AS VARCHAR) AS user_id, event_type, value
    FROM events
"""


def _daily_csv(spark: SparkSession, folder: str) -> str:
    """One folder of CSV per day, the day in the name as a daily feed has it."""
    events = load(spark, folder, "events")
    base = scratch_path(spark, "daily")
    day = F.date_format("ts", "yyyyMMdd")
    write_csv(
        events.select("event_id", "user_id", "event_type", "value", day.alias("day")),
        base, partition_by=["day"],
    )
    return base


@check(_BY_DAY + "WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-21'")
def daily_concat(spark: SparkSession, folder: str) -> DataFrame:
    rows = D.read_dated_files(
        spark, f"{_daily_csv(spark, folder)}/*", pattern=r"/day=(\d{8})/",
        start="2024-01-10", end="2024-01-20", column="file_date",
    )
    typed = project(rows, _EVENTS, keep=["file_date"])
    return typed.withColumn("file_date", F.date_format("file_date", "yyyy-MM-dd"))


@check(_BY_DAY)
def daily_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a stream: a second run finds nothing new to load."""
    source = _daily_csv(spark, folder)
    target, checkpoint = scratch_path(spark, "loaded"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = daily_files(spark, f"{source}/*", _EVENTS, pattern=r"/day=(\d{8})/")
        load_new_files(stream, target, checkpoint).awaitTermination()
    rows = read_table(spark, target)
    return rows.withColumn("file_date", F.date_format("file_date", "yyyy-MM-dd"))


@check("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    write_parquet(load(spark, folder, "orders"), path)
    table = read_table(spark, path, ["o_orderpriority"])
    return table.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@check("""
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def keyed_load(spark: SparkSession, folder: str) -> DataFrame:
    """Three files of changes, the newest first, loaded by key as a stream; then once more with nothing new."""
    events = load(spark, folder, "events")
    base = scratch_path(spark, "changes")
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.where(late), events.where(~late & (F.col("event_id") % 2 == 0)), events.where(~late & (F.col("event_id") % 2 != 0))):
        part.coalesce(1).write.mode("append").parquet(base)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(base)
        load_latest(stream, target, checkpoint, ["user_id", "event_type"], ["ts", "event_id"], 8).awaitTermination()
    load_latest(stream, target, checkpoint, ["user_id", "event_type"], ["ts", "event_id"], 8).awaitTermination()
    return read_latest(spark, target).select("user_id", "event_type", "event_id", "value")


@check("""
    WITH seen AS (
        SELECT o_orderstatus AS part, count(*) + 1 AS lines, count(*) FILTER (o_orderpriority = '5-LOW') AS edited FROM orders GROUP BY 1
    )
    SELECT part, CASE WHEN part = 'F' THEN 'gone' WHEN edited > 0 AND part = 'O' THEN 'changed' ELSE 'same' END AS status, lines
    FROM seen
    UNION ALL SELECT 'X', 'new', count(*) + 1 FROM orders WHERE o_orderstatus = 'F' HAVING count(*) > 0
""")
def file_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two looks at a folder of raw files: one part is renamed, one edited, the rest written again."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("part"))
    looks = []
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("part") == "O")
    for rows in (
        orders,
        orders.withColumn("o_orderpriority", F.when(low, "6-NONE").otherwise(F.col("o_orderpriority")))
        .withColumn("part", F.when(F.col("part") == "F", "X").otherwise(F.col("part"))),
    ):
        base = scratch_path(spark, "look")
        # one task for each part, in the one order that its writer asks for: else it sorts again
        write_csv(rows.repartition("part").sortWithinPartitions("part", "o_orderkey", "o_orderpriority"), base, partition_by=["part"])
        name = F.regexp_extract("path", "/part=([^/]*)/", 1)  # the same file is the same part
        looks.append(file_signatures(spark, base).withColumn("path", name))
    lines = looks[0].select("path", "n_lines").unionByName(looks[1].select("path", "n_lines")).groupBy("path").agg(F.max("n_lines").alias("lines"))
    return changes_of(*looks).join(lines, "path").select(F.col("path").alias("part"), "status", "lines")
