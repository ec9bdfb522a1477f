"""Enrichment and membership joins between registers on normalised keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.functions.cleaning import normalize_key

def join_on_key(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    normalize: bool = True,
) -> DataFrame:
    """Join two registers on a key that may be written with leading zeros.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.  One key may hold a
    third of the left rows, and null keys another: adaptive execution (set in
    :mod:`musterroll.session`) broadcasts a right side that turns out small, and
    otherwise splits the large left partitions, hot and null keys alike, by what it
    measured.  So the rows are read once and only the columns that are used.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    rows = left.withColumn("_key", _comparable(left, left_key, normalize))
    other = right.withColumn("_rkey", _comparable(right, right_key, normalize))
    if rows.schema["_key"].dataType != other.schema["_rkey"].dataType:
        rows = rows.withColumn("_key", F.col("_key").cast("string"))
        other = other.withColumn("_rkey", F.col("_rkey").cast("string"))
    other = other.where(F.col("_rkey").isNotNull())
    if how in ("left_semi", "left_anti"):
        other = other.select("_rkey").distinct()
    return rows.join(other, F.col("_key") == F.col("_rkey"), how).drop("_key", "_rkey")


def _comparable(df: DataFrame, key: str, normalize: bool) -> Column:
    """The key to compare: whole numbers as they are, text without leading zeros."""
    if _is_integer(df, key):
        return F.col(key).cast("bigint")
    return normalize_key(F.col(key)) if normalize else F.col(key)


def _is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def enrich(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: list[str]
) -> DataFrame:
    """Left rows with columns of the matching right row.

    Left rows never multiply: where the right side writes one key several times (say,
    ``012`` and ``12``), the row that is smallest in the given columns counts.  A column
    that the left side has already is not taken.
    """
    wanted = [c for c in columns if c not in left.columns]
    text = not (_is_integer(left, left_key) and _is_integer(right, right_key))
    key = normalize_key(F.col(right_key)) if text else F.col(right_key)
    smallest = F.min(F.struct(*[F.col(c) for c in wanted])).alias("_row")
    side = right.groupBy(key.alias("_side_key")).agg(smallest).select("_side_key", "_row.*")
    return join_on_key(left, side, left_key, "_side_key", "left").drop("_side_key")


def listed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows whose key occurs on the right ("is it on the list")."""
    return join_on_key(left, right, left_key, right_key, "left_semi")


def unlisted(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    return join_on_key(left, right, left_key, right_key, "left_anti")
