"""Changes loaded by key, the newest row of a key winning, with few files rewritten.

The table is split into buckets by a hash of the key.  A batch of changes is reduced to one
row per key, the buckets it touches are read, merged and written over; files of other
buckets stay as they are, names included.

Every batch is merged to a folder of its own before the table changes.  Should a run end
while buckets are being replaced, the stream repeats the batch, and what was merged then
is read along with what the table still has: the newest row wins again, so nothing is lost
or doubled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from musterroll.operators.snapshots import newest_per_key

BUCKET = "_bucket"
BUCKETS = 64


def _if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # no such folder, or no file in it yet
        return None


def merge_changes(
    changes: DataFrame, target: str, staging: str, keys: Sequence[str], order: Sequence[str | Column], buckets: int = BUCKETS
) -> list[int]:
    """Merge changes into the table at ``target``; returns the buckets that were rewritten.

    ``staging`` names this batch: running it again after a crash repairs what was begun.
    ``order`` tells which row of a key is the newest.  The number of buckets stays fixed.
    """
    spark = changes.sparkSession
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")
    newest = newest_per_key(changes, keys, order).withColumn(BUCKET, bucket)
    touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())  # one row per bucket at most
    if not touched:
        return []
    parts = [newest]
    for there in (_if_there(spark, target), _if_there(spark, f"{staging}-*")):
        if there is not None:
            parts.append(there.where(F.col(BUCKET).isin(touched)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    staged = f"{staging}-{uuid.uuid4().hex}"
    merged = newest_per_key(rows, keys, order)
    merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(staged)
    schema = merged.schema
    (
        spark.read.schema(schema).parquet(staged).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(target)
    )
    # the batch is in the table: its folder is emptied
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(staged)
    return touched


def load_latest(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str | Column], buckets: int = BUCKETS
) -> StreamingQuery:
    """Merge what is new in a stream into a table by key, then stop.

    The checkpoint remembers what was loaded; running it again loads only new changes.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_changes(batch, target, f"{checkpoint.rstrip('/')}/merged/{number}", keys, order, buckets)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the table, without their buckets."""
    return spark.read.parquet(target).drop(BUCKET)
