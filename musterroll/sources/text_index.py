"""Trigram index of a materialised table: substring look-ups that read a few blocks.

A table written with an index has a block number per row, some thousand rows in a row of
one file.  The index lists, sorted, in which blocks each run of three characters occurs.  A
needle can only be where all its runs are: the blocks that have them are looked up first,
files without such a block are not opened, and of the others Parquet skips row groups
and pages by their block numbers.  Rows are still tested, so the index decides what is
read and never what is found.

The look-up reads the index's row groups of the needle's runs when a query is planned and
brings block numbers back, :data:`MOST_BLOCKS` at most; a needle in more blocks, or one
shorter than a run, leaves the scan as it was.  So does an index of other files than the
table has now.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators.project import quoted

BLOCK = "_block"
RUN = 3
BLOCK_ROWS, FILE_BLOCKS = 4096, 64
#: Runs of a needle that are looked up, blocks a look-up may bring back, and ranges of
#: block numbers a scan tests; near ranges are joined beyond that.
MOST_RUNS, MOST_BLOCKS, MOST_RANGES = 16, 10_000, 100


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}.trigrams"


def with_blocks(table: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows with the number of their block, in the order they are about to be written."""
    return table.withColumn(BLOCK, F.floor(F.monotonically_increasing_id() / block_rows))


def runs(text: Column) -> Column:
    """All runs of three characters, overlapping ones too; linear in the text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?s)(?=({'.' * RUN}))"), F.lit(1)))


def build(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Index the text columns of a table that was written with blocks."""
    table, target = spark.read.parquet(path), index_path(path)
    cells = F.array(*[F.struct(F.lit(k).alias("key"), quoted(k).cast("string").alias("text")) for k in keys])
    rows = table.select(F.col(BLOCK).alias("block"), F.explode(cells).alias("cell")).select("block", "cell.*")
    found = rows.select("key", F.explode(runs(F.col("text"))).alias("run"), "block").distinct()
    order = ["key", "run", "block"]  # a run that is everywhere spreads over files by its blocks
    found = found.repartitionByRange(*order).sortWithinPartitions(*order)
    found.write.mode("overwrite").parquet(f"{target}/runs")
    blocks = table.groupBy(F.col(BLOCK).alias("block"), F.col("_metadata.file_name").alias("file")).count()
    blocks = blocks.withColumn("keys", F.array(*map(F.lit, keys))).repartitionByRange("block").sortWithinPartitions("block")
    blocks.write.mode("overwrite").parquet(f"{target}/blocks")


def _blocks(spark: SparkSession, path: str) -> DataFrame | None:
    """Blocks of the index with their files, if there is an index of the table's files."""
    try:
        blocks = spark.read.parquet(f"{index_path(path)}/blocks")
    except AnalysisException:
        return None
    now = {f.rsplit("/", 1)[-1] for f in spark.read.parquet(path).inputFiles()}
    then = {r["file"] for r in blocks.select("file").distinct().collect()}  # one row per file
    return blocks if now == then else None


def runs_of(needle: str) -> list[str]:
    """The runs of a needle to look up: all of a short one, evenly spread ones of a long one."""
    found = sorted({needle[i : i + RUN] for i in range(len(needle) - RUN + 1)})
    step = max(1, -(-len(found) // MOST_RUNS))
    return found[::step]


def ranges(blocks: Sequence[int]) -> list[tuple[int, int]]:
    """Sorted block numbers as ranges; the smallest gaps are closed until few are left."""
    gaps = sorted((b - a, i) for i, (a, b) in enumerate(zip(blocks, blocks[1:], strict=False), 1) if b - a > 1)
    cuts = sorted(i for _, i in gaps[max(0, len(gaps) + 1 - MOST_RANGES) :])
    return [(blocks[a], blocks[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(blocks)], strict=True)]


def narrowed(table: DataFrame, path: str, needles: Mapping[str, str]) -> DataFrame:
    """The stored table without the files and blocks that cannot hold all needles.

    ``needles`` are lower-case texts by column.  The result is a superset of the rows that
    hold them, the table itself where the index does not help.
    """
    spark = table.sparkSession
    if not any(len(n) >= RUN for n in needles.values()) or BLOCK not in table.columns:
        return table
    blocks = _blocks(spark, path)
    head = blocks.select("keys").head() if blocks is not None else None
    if head is None:
        return table
    wanted = [(k, r) for k, n in sorted(needles.items()) if k in head["keys"] for r in runs_of(n)]
    if not wanted:
        return table
    either = reduce(or_, [(F.col("key") == k) & (F.col("run") == r) for k, r in wanted])
    holding = spark.read.parquet(f"{index_path(path)}/runs").where(either).groupBy("block").count()
    holding = holding.where(F.col("count") == len(wanted)).select("block")
    rows = holding.join(blocks, "block").select("block", "file").limit(MOST_BLOCKS + 1).collect()
    if len(rows) > MOST_BLOCKS:
        return table
    if not rows:
        return table.where(F.lit(False))
    files = sorted({r["file"] for r in rows})
    held = [F.col(BLOCK).between(a, b) for a, b in ranges(sorted({r["block"] for r in rows}))]
    return table.where(F.col("_metadata.file_name").isin(*files) & reduce(or_, held))
