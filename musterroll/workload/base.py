"""Registry of checked queries and the loader of the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(run: Query) -> Query:
        CHECKS[run.__name__] = Check(run.__name__, run, sql)
        return run

    return register


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
