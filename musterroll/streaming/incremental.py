"""Daily files as a stream: only files that were not loaded before are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from musterroll.operators.project import project
from musterroll.sources.delimited import DATE_IN_NAME, date_from_path
from musterroll.specs.model import TableSpec


def source_schema(spec: TableSpec) -> T.StructType:
    """All-text schema of a register's files, in the order of the spec."""
    return T.StructType([T.StructField(c.source, T.StringType()) for c in spec.columns])


def daily_files(
    spark: SparkSession,
    folder: str,
    spec: TableSpec,
    delimiter: str = ",",
    files_per_batch: int = 1000,
    date_column: str = "file_date",
    pattern: str = DATE_IN_NAME,
) -> DataFrame:
    """Stream of typed rows from the files of a folder, dated by file name."""
    raw = (
        spark.readStream.schema(source_schema(spec))
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn(date_column, date_from_path(F.col("_metadata.file_path"), pattern))
    )
    return project(raw, spec, keep=[date_column])


def load_new_files(
    stream: DataFrame, target: str, checkpoint: str, date_column: str = "file_date"
) -> StreamingQuery:
    """Append what is new to a Parquet table partitioned by date, then stop.

    The checkpoint remembers the files already loaded, so running it again after
    a crash or on the next day neither skips nor repeats one.
    """
    return (
        stream.writeStream.format("parquet")
        .partitionBy(date_column)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
