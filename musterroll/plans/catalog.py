"""The catalogue of table specs as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators.project import quoted
from musterroll.operators.search import relevance
from musterroll.specs.model import Catalog, TableSpec

_TABLES = """id string, name string, description string, update_frequency string,
    is_curated boolean, layout string, period_coverage string, cache_kind string, keywords string"""
_COLUMNS = """table_id string, ordinal int, key string, source_column string,
    description string, unit string, role string, dtype string, kind string"""


def tables(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """One row per table, sorted by id."""
    rows = [
        (
            s.id, s.name, s.description, s.cadence, True, s.layout, s.period_coverage,
            s.cache_kind, " ".join(s.keywords),
        )
        for s in catalog.specs()
    ]
    return spark.createDataFrame(rows, _TABLES).orderBy("id")


def column_details(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """One row per column; ``kind`` parts filterable dimensions from measures."""
    rows = [
        (
            s.id, i, c.key, c.source, c.label, c.unit, c.role, c.dtype,
            "measure" if c.role == "measure" else "dimension",
        )
        for s in specs
        for i, c in enumerate(s.columns)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def enum_values(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """Accepted filter aliases and the source values they stand for."""
    rows = [
        (s.id, key, alias, source)
        for s in specs
        for key, enum in s.enums.items()
        for alias, source in enum.items()
    ]
    return spark.createDataFrame(
        rows, "table_id string, key string, alias string, source_value string"
    )


def search(spark: SparkSession, catalog: Catalog, query: str, limit: int = 10) -> DataFrame:
    """Tables ranked by relevance to a query."""
    rows = tables(spark, catalog)
    name = F.concat_ws(" ", "id", "name")
    hits = relevance(
        rows,
        query,
        name=name,
        keywords=F.concat_ws(" ", name, "keywords"),
        description=F.col("description"),
        limit=limit,
        tiebreak=["id"],
    )
    return hits.select(
        "id", "name", "description", "update_frequency", "is_curated", "relevance"
    ).orderBy(F.col("relevance").desc(), "id")


def column_profile(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The column details of a table with the number of filled cells of each column."""
    counts = [
        F.struct(F.lit(c.key).alias("key"), F.count(quoted(c.key)).alias("filled"))
        for c in spec.columns
    ]
    filled = rows.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    return column_details(rows.sparkSession, [spec]).join(filled, "key")
