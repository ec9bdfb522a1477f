"""Signatures of raw files: which files are new, changed or gone since the last look.

Length and time of a file come from its metadata.  Only files whose metadata differ from
the last look are read, by Spark's splittable text source, reduced per file inside each
task to the hash of the first line, of the last line and a sum over all lines.  Files
without a byte are not listed; lines that change places between the first and the last
leave a signature as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNATURE = ("length", "n_lines", "head", "tail", "digest")


def file_metadata(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, length, modified) of the files under paths; no file is opened."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    meta = F.col("_metadata")
    return spark.read.format("binaryFile").load(paths).select(
        meta["file_path"].alias("path"),
        meta["file_size"].alias("length"),
        meta["file_modification_time"].alias("modified"),
    )


def content_signatures(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, n_lines, head, tail, digest) of files with at least one byte.

    The digest adds up two hashes of every line, so that doubled lines do not cancel out.
    All that is kept of a split are numbers, also of its first and last line: text would
    have each task sort its lines.
    """
    md5 = F.md5(F.col("value").cast("binary"))
    first, last = (F.conv(F.substring(md5, at, 16), 16, -10).cast("bigint") for at in (1, 17))
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), first.alias("first"), last.alias("last"), F.xxhash64("value").alias("hash"),
    )
    wide = F.col("hash").cast("decimal(38,0)")
    splits = lines.groupBy("path", "block").agg(
        F.count("*").alias("n_lines"),
        *[by(half, "line").alias(f"{end}_{half}") for end, by in (("head", F.min_by), ("tail", F.max_by)) for half in ("first", "last")],
        F.sum(wide).alias("sum"),
        F.sum(F.xxhash64("hash", F.lit(1)).cast("decimal(38,0)")).alias("other"),
    )

    def text(end: str) -> Column:
        return F.lower(F.concat(*[F.lpad(F.hex(f"{end}_{half}"), 16, "0") for half in ("first", "last")]))

    return splits.groupBy("path").agg(
        F.sum("n_lines").alias("n_lines"),
        F.min_by(text("head"), "block").alias("head"),
        F.max_by(text("tail"), "block").alias("tail"),
        F.concat_ws(":", F.sum("sum").cast("string"), F.sum("other").cast("string")).alias("digest"),
    )


def file_signatures(spark: SparkSession, paths: str | Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(path, length, modified, n_lines, head, tail, digest) of every file.

    ``known`` are signatures taken before: files with the length and time they had then
    keep theirs and are not read.
    """
    now = file_metadata(spark, paths)
    if known is not None:
        old = known.select("path", "length", "modified", *SIGNATURE[1:])
        kept = now.join(old, ["path", "length", "modified"])
        now = now.join(old, ["path", "length", "modified"], "left_anti")
    fresh = [unquote(r["path"]) for r in now.select("path").collect()]  # one address per file to read
    if fresh:
        read = now.join(content_signatures(spark, fresh), "path")
        read = read.select("path", "length", "modified", *SIGNATURE[1:])
    else:
        read = now.select("path", "length", "modified", F.lit(0).cast("bigint").alias("n_lines"), *[F.lit(None).cast("string").alias(c) for c in SIGNATURE[2:]])
    return read if known is None else read.unionByName(kept.select(*read.columns))


def file_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, status): ``new``, ``gone``, ``changed`` or ``same`` by content, whatever the time says."""
    same = F.struct(*SIGNATURE)
    old = before.select("path", same.alias("old"))
    new = after.select("path", same.alias("new"))
    status = (
        F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone")
        .when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    )
    return old.join(new, "path", "full_outer").select("path", status.alias("status"))
