"""Alias projection and typing: source columns to friendly, clean columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.functions import cleaning as C
from musterroll.specs.model import ColumnSpec, TableSpec, some


def quoted(name: str) -> Column:
    """Column reference by exact name (dots, percent signs and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_sources(df: DataFrame, spec: TableSpec) -> None:
    missing = [c.source for c in spec.columns if c.source not in df.columns]
    if missing:
        raise ValueError(f"table {spec.id!r} lacks expected columns: {some(missing, 5)}")


def _is_raw_text(spec: ColumnSpec, source_type: T.DataType) -> bool:
    return isinstance(source_type, T.StringType) and spec.dtype != "native"


def typed(col: Column, spec: ColumnSpec, source_type: T.DataType) -> Column:
    """One column, its text already clean, in the type its spec declares."""
    is_text = isinstance(source_type, T.StringType)
    is_number = isinstance(source_type, T.NumericType)
    if spec.dtype == "long":
        return col.try_cast("bigint") if is_number else C.to_long(col)
    if spec.dtype == "double":
        if isinstance(source_type, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(col), col.cast("double"))
        return col.cast("double") if is_number else C.to_double(col)
    if spec.dtype == "date":
        if isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, C.ISO_DATE_FORMAT)
        return C.date_to_iso(col.cast("string"))
    if spec.dtype == "string" and not is_text:
        return C.whole_number_text(col) if is_number else C.clean_string(col)
    return col


def _clean(df: DataFrame, spec: TableSpec, kept: Sequence[str]) -> DataFrame:
    """Declared columns under their keys, raw text stripped and blanks made null.

    One step per ``select``: each step uses its input several times, and nested in
    one expression they would grow into methods too large to be compiled well.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    raw = {c.key for c in spec.columns if _is_raw_text(c, types[c.source])}
    out = df.select(
        *[
            (C.strip_text(quoted(c.source)) if c.key in raw else quoted(c.source)).alias(c.key)
            for c in spec.columns
        ],
        *[quoted(n) for n in kept],
    )
    if not raw:
        return out
    return out.select(
        *[
            (C.null_tokens(quoted(c.key)) if c.key in raw else quoted(c.key)).alias(c.key)
            for c in spec.columns
        ],
        *[quoted(n) for n in kept],
    )


def project(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Rename, clean and type the declared columns.

    A wide table keeps only declared columns and those named in ``keep``.  A
    transposed table also keeps the undeclared ones: they are its periods.
    """
    check_sources(df, spec)
    types = {f.name: f.dataType for f in df.schema.fields}
    sources = {c.source for c in spec.columns}
    kept = list(keep) if spec.layout == "wide" else [n for n in df.columns if n not in sources]
    declared = [
        typed(quoted(c.key), c, types[c.source]).alias(
            c.key, metadata={"role": c.role, "unit": c.unit or "", "source": c.source}
        )
        for c in spec.columns
    ]
    return _clean(df, spec, kept).select(*declared, *[quoted(n) for n in kept])


def coercion_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Filled and unreadable cells per typed column: one pass, one small row set."""
    check_sources(df, spec)
    types = {f.name: f.dataType for f in df.schema.fields}
    checked = [c for c in spec.columns if c.dtype in ("long", "double")]
    if not checked:
        raise ValueError(f"table {spec.id!r} declares no numeric column")
    clean = _clean(df, spec, ())
    cells = clean.select(
        *[quoted(c.key).alias(f"raw_{c.key}") for c in checked],
        *[typed(quoted(c.key), c, types[c.source]).alias(f"typed_{c.key}") for c in checked],
    )
    aggregates = [
        F.struct(
            F.lit(c.key).alias("key"),
            F.count(quoted(f"raw_{c.key}")).alias("filled"),
            F.count_if(
                quoted(f"raw_{c.key}").isNotNull() & quoted(f"typed_{c.key}").isNull()
            ).alias("failed"),
        )
        for c in checked
    ]
    return cells.agg(F.array(*aggregates).alias("report")).select(F.inline("report"))
