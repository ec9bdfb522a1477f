"""Small aggregates over a table or over observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.functions.periods import check_period_range
from musterroll.operators.snapshots import is_stale, stale_reason
from musterroll.specs.model import TableSpec


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Filled values of a column as text, once each."""
    return df.select(F.col(column).cast("string").alias(column)).na.drop().distinct()


def row_count() -> Column:
    return F.count("*")


def common_unit(unit: Column) -> Column:
    """The unit if all filled units agree, else null.

    Minimum and maximum agree exactly when there is one distinct value, so no
    distinct aggregate is needed.
    """
    unit = F.nullif(unit, F.lit(""))
    return F.when(F.min(unit) == F.max(unit), F.min(unit))


def period_extent(period: Column, start: str | None, end: str | None) -> tuple[Column, Column]:
    """First and last period as text; a given bound is echoed instead."""
    period = F.nullif(period, F.lit(""))
    first = F.lit(start) if start else F.min(period)
    last = F.lit(end) if end else F.max(period)
    return first, last


def summary(
    observations: DataFrame,
    spec: TableSpec,
    start: object = None,
    end: object = None,
    source: str = "",
    attribution: str = "",
    snapshot_date: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """One row that describes a result: one pass over the observations.

    With the date of the snapshot and the moment of the answer it also says whether
    the snapshot is older than its cadence allows.
    """
    low, high = check_period_range(start, end)
    first, last = period_extent(F.col("period"), low, high)
    taken, now = F.lit(snapshot_date).cast("date"), F.lit(as_of).cast("timestamp")
    cadence, today = F.lit(spec.cadence), F.to_date(now)
    return observations.agg(
        row_count().alias("row_count"),
        common_unit(F.col("unit")).alias("unit"),
        first.alias("period_start"),
        last.alias("period_end"),
    ).select(
        F.lit(spec.id).alias("table_id"),
        F.lit(spec.name).alias("table_name"),
        "row_count",
        "unit",
        "period_start",
        "period_end",
        F.lit(source).alias("source"),
        F.lit(attribution).alias("attribution"),
        F.lit(spec.source_page).cast("string").alias("source_page"),
        now.alias("retrieved_at"),
        F.coalesce(is_stale(cadence, taken, today), F.lit(False)).alias("stale"),
        stale_reason(cadence, taken, today).alias("stale_reason"),
    )


def year_hint(df: DataFrame, column: str, requested: int) -> DataFrame:
    """Range of the four-digit years in a column and where a requested year lies.

    ``direction`` is BEFORE or AFTER when the year is outside the range, IN RANGE
    when it is inside but absent, FOUND when it occurs, and null without years.
    """
    text = F.col(column).cast("string")
    year = F.when(text.rlike(r"^[0-9]{4}$"), text.try_cast("int"))
    wanted = F.lit(requested)
    return df.agg(
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.coalesce(F.bool_or(year == wanted), F.lit(False)).alias("found"),
    ).select(
        wanted.alias("requested"),
        "first_year",
        "last_year",
        "found",
        F.when(F.col("found"), "FOUND")
        .when(wanted < F.col("first_year"), "BEFORE")
        .when(wanted > F.col("last_year"), "AFTER")
        .when(F.col("first_year").isNotNull(), "IN RANGE")
        .alias("direction"),
    )
