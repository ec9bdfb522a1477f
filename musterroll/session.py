"""Session settings the plans count on; all of them are Spark's own."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # adaptive plans: broadcast by measured size, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the plan above must then shuffle once more
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # lets every task cut a ranked group to the largest listing before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # generated methods beyond this size are not compiled by the JVM; split them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
PARTITION_BYTES = 128 * 1024 * 1024


def configure(
    builder: SparkSession.Builder, shuffled_bytes: int | None = None
) -> SparkSession.Builder:
    """Apply the settings; size shuffles from the data they have to carry.

    Adaptive execution merges partitions that turn out small, so the estimate may
    be generous.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_bytes is not None:
        partitions = max(200, -(-shuffled_bytes // PARTITION_BYTES))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder
