"""Friendly filters as one predicate that Catalyst can split and push down."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.functions.cleaning import parse_date
from musterroll.functions.periods import date_bounds
from musterroll.specs.model import TableSpec

# Fixed value: wildcard characters dropped from a substring needle.
WILDCARDS = "*~"


def parse_filters(filters: object) -> dict:
    """Filters as a dict, from a dict, JSON text or None."""
    if filters is None:
        return {}
    if isinstance(filters, str):
        try:
            filters = json.loads(filters)
        except json.JSONDecodeError as error:
            raise ValueError(f"filters must be a JSON object, got invalid JSON: {error}") from error
    if not isinstance(filters, dict):
        raise ValueError(f"filters must be a dict, got {type(filters).__name__}")
    return filters


def parse_filter_column(col: Column) -> Column:
    """Column form for tables of queries: JSON text to a map of filters."""
    return F.from_json(col, "map<string,string>")


def needle_of(needle: str, name: str = "value") -> str:
    """What a substring filter looks for, in lower case; wildcards are dropped."""
    text = needle
    for mark in WILDCARDS:
        text = text.replace(mark, "")
    text = text.strip()
    if not text:
        raise ValueError(f"Filter {name!r}: nothing left to match after removing '*' and '~'")
    return text.lower()


def contains_text(col: Column, needle: str, name: str = "value") -> Column:
    """Case-insensitive literal substring; wildcards in the needle are dropped."""
    return F.lower(col.cast("string")).contains(needle_of(needle, name))


def equals_text(col: Column, values: list[str], dtype: T.DataType) -> Column:
    """Exact match as text.

    On integer columns the values become integer literals, so that the
    comparison still reaches the scan; text that is not the plain spelling of an
    integer cannot equal one and drops out.
    """
    options: list = values
    if isinstance(dtype, T.IntegralType):
        whole = [v for v in values if v.removeprefix("-").isdecimal() and str(int(v)) == v]
        options = [int(v) for v in whole if abs(int(v)) < 2**63]
    elif not isinstance(dtype, T.StringType):
        col = col.cast("string")
    if not options:
        return F.lit(False)
    if len(options) == 1:
        return col == F.lit(options[0])
    return col.isin(*options)


def predicate(spec: TableSpec, filters: object, schema: T.StructType) -> Column | None:
    """AND over one predicate per filter, or None without filters.

    A list is an OR of exact values.  A single value is a substring on ids and on
    dimensions without an enum, and an exact (translated) value on enum columns.
    """
    parts: list[Column] = []
    substring = spec.substring_keys()
    for key, value in parse_filters(filters).items():
        spec.check_filter_key(key)
        col, dtype = F.col(key), schema[key].dataType
        if isinstance(value, list):
            if not value:
                raise ValueError(f"Filter {key!r} has an empty list")
            values = [spec.translate(key, str(v).strip()) for v in value]
            parts.append(equals_text(col, values, dtype))
        elif key in substring:
            parts.append(contains_text(col, str(value).strip(), key))
        else:
            parts.append(equals_text(col, [spec.translate(key, str(value).strip())], dtype))
    return reduce(lambda a, b: a & b, parts) if parts else None


def apply_filters(df: DataFrame, spec: TableSpec, filters: object) -> DataFrame:
    """Rows of a projected table that pass all filters."""
    keep = predicate(spec, filters, df.schema)
    return df if keep is None else df.where(keep)


def drop_blank_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows in which every listed column that exists is null."""
    present = [k for k in keys if k in df.columns]
    return df.na.drop(how="all", subset=present) if present else df


def drop_empty_dimensions(df: DataFrame, column: str = "dimensions") -> DataFrame:
    return df.where(F.size(column) > 0)


def date_range(
    df: DataFrame, column: str, start: object = None, end: object = None, iso: bool = False
) -> DataFrame:
    """Rows whose date lies between two partial bounds, both inclusive.

    Date and timestamp columns are compared half-open as they are, so the bounds
    reach the scan.  Text columns are parsed first; text that is no date drops.
    ``iso`` says that the dates in a text column are ISO text: they then sort as
    text, and the bounds reach the scan as well.
    """
    low, high = date_bounds(start, end)
    if low is None and high is None:
        return df
    dtype = df.schema[column].dataType
    is_text = isinstance(dtype, T.StringType)
    raw = F.col(column)
    col, target = (parse_date(raw), "date") if is_text else (raw, dtype.simpleString())
    keep = F.lit(True)
    if low is not None:
        keep = keep & (col >= F.lit(low.isoformat()).cast(target))
        if is_text and iso:
            keep = keep & (raw >= low.isoformat())
    if high is not None:
        after = high + dt.timedelta(days=1)
        keep = keep & (col < F.lit(after.isoformat()).cast(target))
        if is_text and iso:
            keep = keep & (raw < after.isoformat())
    return df.where(keep)
