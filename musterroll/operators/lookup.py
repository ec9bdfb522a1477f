"""Alias lookups on columns: alias to source value, and source value to label."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.functions.regions import normalize_region


def literal_map(values: dict[str, str]) -> Column:
    """An enum as a constant of the plan, one literal whatever its size.

    A look-up compares with the entries one by one; enums of many thousands are
    better kept as tables, see :func:`lookup_join`.
    """
    return F.from_json(F.lit(json.dumps(values)), "map<string, string>")


def translate_column(col: Column, enum: dict[str, str], region: bool = False) -> Column:
    """Source value for a column of aliases: alias, then source value, then region.

    Values that resolve to nothing become null: they are reported, not raised.
    """
    known = F.when(col.isin(*sorted(set(enum.values()))), col)
    out = F.coalesce(F.try_element_at(literal_map(enum), col), known)
    if not region:
        return out
    code = normalize_region(col)
    codes = {v.upper(): v for v in enum.values()}
    return F.coalesce(out, F.try_element_at(literal_map(codes), code))


def lookup_join(
    df: DataFrame, column: str, lookup: DataFrame, alias: str, canonical: str, into: str
) -> DataFrame:
    """Table form of the lookup: a left join; rows without a match keep null.

    Each alias is reduced to one source value first, so rows never multiply.
    """
    unique = lookup.groupBy(F.col(alias).alias("_alias")).agg(F.min(canonical).alias(into))
    return df.join(unique, df[column] == unique["_alias"], "left").drop("_alias")


def reverse_enum(enum: dict[str, str]) -> dict[str, str]:
    """Source value to alias; of several aliases the last one wins."""
    return {source: alias for alias, source in enum.items()}


def label_column(col: Column, enum: dict[str, str] | None) -> Column:
    """Show the alias of a source value, or the value itself without one."""
    if not enum:
        return col
    return F.coalesce(F.try_element_at(literal_map(reverse_enum(enum)), col), col)
