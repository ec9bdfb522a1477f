"""Column expressions that turn raw register text into clean, typed values.

Everything here is a plain ``Column -> Column`` function built from Spark's own
expressions, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters treated as blank when stripping text, the texts
# that mean "missing" in a register extract, and the source date formats.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NULL_TOKENS = ("", "NULL", "null")
SOURCE_DATE_FORMAT = "d/M/yyyy"
PADDED_DATE = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
ISO_DATE_FORMAT = "yyyy-MM-dd"


def strip_text(col: Column) -> Column:
    """Strip Unicode blanks (also NBSP) at both ends; blanks inside are kept."""
    return F.btrim(col, F.lit(WHITESPACE))


def collapse_spaces(col: Column) -> Column:
    """Opt-in: turn every run of Unicode blanks into one plain space."""
    return strip_text(F.regexp_replace(col, r"(?U)[\s\x1c-\x1f]+", " "))


def null_tokens(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Texts that stand for a missing value become null."""
    return F.when(~col.isin(*tokens), col)


def clean_string(col: Column) -> Column:
    return strip_text(col.cast("string"))


def whole_number_text(col: Column) -> Column:
    """Text of a number; ``94600082111.0`` prints as ``94600082111``."""
    number = col.cast("double")
    whole = number.try_cast("bigint")
    return F.when(whole.cast("double") == number, whole.cast("string")).otherwise(
        col.cast("string")
    )


def to_long(col: Column) -> Column:
    """Whole number or null, value by value and without rounding.

    ``"12.0"`` is 12; ``"12.5"`` and ``"12.0000000000001"`` are null.  Powers of ten
    (``"1e3"``) are read as doubles, which hold whole numbers up to 2**53 exactly.
    """
    text = strip_text(col.cast("string"))
    digits = F.regexp_extract(text, r"^([+-]?[0-9]*)(\.0*)?$", 1)
    power = F.when(text.rlike("[eE]"), text.try_cast("double"))
    exact = (F.abs(power) <= float(1 << 53)) & (F.floor(power) == power)
    return (
        F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), digits.try_cast("bigint"))
        .when(text.rlike(r"^[+-]?\.0+$"), F.lit(0).cast("bigint"))
        .when(exact, power.try_cast("bigint"))
    )


def to_double(col: Column) -> Column:
    """Number or null; NaN counts as missing."""
    number = strip_text(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def date_to_iso(col: Column, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """Day/month/year text becomes ISO text; anything else passes through.

    Padded dates of the usual format are rearranged as text and checked by a cast;
    only odd ones go through the much slower pattern parser.
    """
    parsed = F.coalesce(F.date_format(F.try_to_date(col, fmt), ISO_DATE_FORMAT), col)
    if fmt != SOURCE_DATE_FORMAT:
        return parsed
    day, month, year = F.substring(col, 1, 2), F.substring(col, 4, 2), F.substring(col, 7, 4)
    moved = F.concat_ws("-", year, month, day).try_cast("date").cast("string")
    return F.when(col.rlike(PADDED_DATE), F.coalesce(moved, col)).otherwise(parsed)


def parse_date(col: Column, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """Typed companion of a date text: day/month/year or ISO, else null."""
    text = strip_text(col)
    return F.coalesce(F.try_to_date(text, fmt), F.try_to_date(text, ISO_DATE_FORMAT))


def normalize_key(col: Column) -> Column:
    """Key without leading zeros, so ``000221137`` and ``221137`` compare equal."""
    text = strip_text(col.cast("string"))
    return F.when(F.length(text) > 0, F.regexp_replace(text, r"^0+(?=\d)", ""))


def truncate_text(col: Column, max_chars: int, suffix: str) -> Column:
    """Cut text longer than ``max_chars`` and mark the cut with ``suffix``."""
    return F.when(
        F.length(col) > max_chars, F.concat(F.substring(col, 1, max_chars), F.lit(suffix))
    ).otherwise(col)


def coercion_failed(raw: Column, typed: Column) -> Column:
    """True where a filled raw value did not survive its type conversion."""
    return null_tokens(strip_text(raw.cast("string"))).isNotNull() & typed.isNull()
