"""Parquet in and out: guarded scans, one-off conversion, many registers at once."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.operators.filters import drop_blank_rows
from musterroll.operators.project import project, quoted
from musterroll.sources import text_index as index
from musterroll.specs.model import Catalog, TableSpec, some


def shared_dir(spark: SparkSession) -> str | None:
    """The folder the cluster shares between its executors, if it names one."""
    context = spark.sparkContext
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder of the cluster.

    Without one (a single machine, as in tests) a local temporary folder is used.
    """
    base = shared_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="musterroll-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; only the named columns are read."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[quoted(c) for c in columns])


def first_rows(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """The first rows of a Parquet table in file order, without reading the rest.

    Rows per file come from file footers, a few files at a time, until enough are
    found; the scan is then restricted to those files.  No row is shuffled.
    """
    table = spark.read.parquet(path)
    address, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    # a scan names local files with one slash, the listing with three
    files = sorted(re.sub("^file:/+", "file:/", f) for f in table.inputFiles())
    chosen: list[str] = []
    missing, batch = rows, 8
    while files and missing > 0:
        head, files = files[:batch], files[batch:]
        batch *= 2
        counted = table.where(address.isin(*head)).groupBy(address.alias("file")).count()
        counts = {r["file"]: r["count"] for r in counted.collect()}
        for name in head:
            if missing <= 0:
                break
            chosen.append(name)
            if counts.get(name, 0) >= missing:
                last, keep = name, missing
            missing -= counts.get(name, 0)
    if missing > 0 or not chosen:
        return table
    return table.where(address.isin(*chosen) & ((address != last) | (place < keep)))


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, object] | None = None
) -> int:
    """Snappy Parquet through Spark's commit protocol; returns the rows written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer.options(compression="snappy", **(options or {})).partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_csv(
    flat: DataFrame, path: str, delimiter: str = ",", encoding: str = "UTF-8",
    partition_by: Sequence[str] = (),
) -> None:
    """CSV files with a header, one per task; text is kept to the last blank."""
    (
        flat.write.mode("overwrite")
        .option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .partitionBy(*partition_by)
        .csv(path)
    )


def materialise(
    raw: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    spec: TableSpec | None = None,
    cluster_by: Sequence[str] = (),
    text_index: Sequence[str] = (),
    block_rows: int = index.BLOCK_ROWS,
) -> int:
    """Convert a raw text table to Parquet once, so that queries scan columns.

    With a spec the table is written clean under friendly names and without blank
    rows, which lets later filters reach the scan.  ``cluster_by`` sorts the files by
    columns, so that exact lookups skip most row groups; a hash of row and reading
    task as last sort key lets a hot value, and copies of one row, spread over
    several files.  ``text_index`` names text columns whose substrings are looked up often:
    rows get a block number and the columns a trigram index beside the table.  An empty
    input is an error and leaves an earlier table as it was.
    """
    table = raw if columns is None else raw.select(*[quoted(c) for c in columns])
    if spec is not None:
        table = drop_blank_rows(project(table, spec), [c.key for c in spec.with_role("dimension")])
    if table.isEmpty():
        raise ValueError("the input has no rows (a header alone, or a cut-off file)")
    if cluster_by:
        spread = F.xxhash64(*[quoted(c) for c in table.columns], F.spark_partition_id())
        order = [*[quoted(c) for c in cluster_by], F.col("_spread")]
        table = table.withColumn("_spread", spread)
        table = table.repartitionByRange(*order).sortWithinPartitions(*order).drop("_spread")
    if not text_index:
        return write_parquet(table, path)
    pages = {"maxRecordsPerFile": block_rows * index.FILE_BLOCKS, "parquet.page.row.count.limit": block_rows}
    rows = write_parquet(index.with_blocks(table, block_rows), path, options=pages)
    index.build(raw.sparkSession, path, text_index)
    return rows


STATUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


def materialise_many(
    spark: SparkSession,
    catalog: Catalog,
    load: Callable[[TableSpec], DataFrame],
    target: Callable[[TableSpec], str],
    ids: Iterable[str] | None = None,
    max_concurrency: int = 2,
) -> DataFrame:
    """Materialise many tables; one failing table does not stop the others.

    Returns id, status (``ok`` or ``error: ...``) and rows per table.
    """
    ids = catalog.ids() if ids is None else list(ids)
    unknown = [i for i in ids if i not in catalog.ids()]
    if unknown:
        raise ValueError(f"unknown table ids: {some(unknown)}")

    def run(table_id: str) -> tuple[str, str, int | None]:
        spec = catalog.get(table_id)
        try:
            return table_id, "ok", materialise(load(spec), target(spec), spec=spec)
        except Exception as error:  # noqa: BLE001 - reported per table
            return table_id, f"error: {type(error).__name__}: {error}", None

    with ThreadPoolExecutor(max(1, max_concurrency)) as pool:
        rows = list(pool.map(run, ids))
    return spark.createDataFrame(rows, STATUS_SCHEMA)
