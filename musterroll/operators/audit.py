"""Checks of a table against its spec, as data-quality jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.operators.project import quoted
from musterroll.specs.model import TableSpec


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Source columns the spec names and the table lacks (metadata only)."""
    return [c.source for c in spec.columns if c.source not in df.columns]


def enum_audit(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared codes against the values of a projected table.

    One row per enum column and code: ``ok``, ``unseen`` (declared, never in the
    data: a filter on it finds nothing) or ``undeclared`` (in the data only).
    """
    if not spec.enums:
        raise ValueError(f"table {spec.id!r} has no enum columns")
    keys = list(spec.enums)
    codes = [(k, code) for k in keys for code in sorted(set(spec.enums[k].values()))]
    declared = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(code).alias("code")) for k, code in codes]
    )
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), quoted(k).cast("string").alias("code")) for k in keys
    ])).alias("cell")).select("cell.*").where(F.col("code").isNotNull())
    # every declared code takes part with no rows, so one aggregate serves both sides
    seeds = df.sparkSession.range(1).select(F.inline(declared)).withColumn("_n", F.lit(0))
    marked = cells.withColumn("_n", F.lit(1)).unionByName(seeds)
    return (
        marked.groupBy("key", "code")
        .agg(F.sum("_n").alias("rows"), F.bool_or(F.col("_n") == 0).alias("_declared"))
        .select(
            "key",
            "code",
            "rows",
            F.when(~F.col("_declared"), "undeclared")
            .when(F.col("rows") == 0, "unseen")
            .otherwise("ok")
            .alias("status"),
        )
    )


def duplicate_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Natural keys that occur more than once in a projected table."""
    if not spec.natural_key:
        raise ValueError(f"table {spec.id!r} declares no natural key")
    return (
        df.groupBy(*[quoted(k) for k in spec.natural_key])
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > 1)
    )


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whether each column holds one value throughout, and which."""
    checks = [
        F.struct(
            F.lit(c).alias("key"),
            F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("constant"),
            F.min(quoted(c).cast("string")).alias("smallest"),
        )
        for c in columns
    ]
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
