"""Sub-table of a sheet-like grid: header row, data start row, row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from musterroll.operators.project import quoted
from musterroll.sources.delimited import normalize_header


def with_row_number(grid: DataFrame, column: str = "_row") -> DataFrame:
    """Number the rows of a scan of one file from 1 in file order.

    Rows are numbered inside each split; the offsets of the splits come from one
    count per split, so no task handles more than a split.
    """
    split = F.shiftright(F.col("_id"), 33).alias("_split")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    rows = grid.withColumn("_id", F.monotonically_increasing_id()).select("*", split)
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        grid.select(F.spark_partition_id().alias("_split"))
        .groupBy("_split")
        .agg(F.count("*").alias("_n"))
        .select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # one row per split of the scan: small whatever the file holds
    offsets = F.broadcast(offsets.withColumnRenamed("_split", "_at"))
    return (
        rows.join(offsets, F.col("_split") == F.col("_at"))
        .withColumn(column, F.col("_before") + place + 1)
        .drop("_id", "_split", "_at", "_before")
    )


def carve(
    grid: DataFrame,
    header_row: int,
    data_start_row: int | None = None,
    max_rows: int | None = None,
    row: str | Column = "_row",
) -> DataFrame:
    """Rows of a sub-table, named by its header row; all row numbers count from 1.

    ``grid`` has positional columns and a row number.  Only the header row is
    fetched at plan time.
    """
    if header_row < 1:
        raise ValueError(f"header_row counts from 1, got {header_row}")
    start = header_row + 1 if data_start_row is None else data_start_row
    if start <= header_row:
        raise ValueError(f"data_start_row ({start}) must come after header_row ({header_row})")
    number = F.col(row) if isinstance(row, str) else row
    cells = [c for c in grid.columns if c != row]
    head = grid.where(number == header_row).select(*[quoted(c) for c in cells]).head()
    if head is None:
        raise ValueError(f"the grid has no row {header_row}")
    keep = number >= start
    if max_rows is not None:
        keep = keep & (number < start + max_rows)
    named = [(c, normalize_header(str(h))) for c, h in zip(cells, head) if h is not None]
    return grid.where(keep).select(*[quoted(c).alias(name) for c, name in named])
