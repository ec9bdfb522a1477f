"""Compare a Spark result with DuckDB's answer on the same Parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) else repr(round(v, 9)))
    return int(v) if isinstance(v, int) else str(v)


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, sql: str, con) -> str | None:
    """None when both give the same rows, else what differs."""
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if not want:
        return "the SQL gives no rows: nothing is checked"
    if got != want:
        extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows instead of {sum(want.values())}; extra {extra}; lacking {lacking}"
    return None
