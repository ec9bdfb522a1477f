"""Helpers of the training-data operators: tables, scratch folder, let-bindings."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``.  Only where that is unset and Spark
    runs in one process (as in tests) a folder of this machine is set.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="musterroll-shared-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks, not the steps before.
    ``by`` names a column of few values whose rows are kept in folders of their own.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Spark would otherwise copy the expression into every lambda that mentions it and
    evaluate it again for each element.
    """
    return F.transform(F.array(value), body)[0]


def packed(values: np.ndarray) -> bytes:
    """An array as bytes; long runs of zeros, as of counts and marks of few texts, take little."""
    return zlib.compress(values.tobytes(), 1)


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


def longs(values: list[int]) -> Column:
    """A constant array of longs, parsed as one expression."""
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")") if values else F.expr(
        "cast(array() as array<bigint>)"
    )


def added_up(packed: DataFrame, add, schema: str) -> DataFrame:
    """Add up what tasks sent in blocks: one row per ``block``.

    Two steps, so that no task holds the parts of all others: tasks meet in groups of
    256, then the groups' sums.  ``add`` makes one row of a table of parts of one block.
    """
    group = F.floor(F.spark_partition_id() / 256).cast("int")
    grouped = packed.withColumn("tasks", group).groupBy("block", "tasks").applyInArrow(add, schema)
    return grouped.groupBy("block").applyInArrow(add, schema)
