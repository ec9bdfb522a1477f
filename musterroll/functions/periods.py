"""Period text (``YYYY``, ``YYYY-YY``, ``YYYY-MM``, ``YYYY-MM-DD...``) and date bounds.

``YYYY-NN`` is a month for NN 01-12 and a financial year for 13-99, so the
financial year 2011-12 reads as December 2011.  That ambiguity is in the data;
it is kept, not resolved.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from musterroll.functions.cleaning import WHITESPACE, strip_text

# Month, financial year, full date (cut to its month) and year; group by group.
PERIOD_FORMS = (
    r"(?s)^(?:([0-9]{4}-(?:0[1-9]|1[0-2]))|([0-9]{4})-(?:1[3-9]|[2-9][0-9])"
    r"|(.{4}-.{2})-.{2,}|([0-9]{4})|.*)\z"
)

# Accepted shape and integer range of a period argument.
PERIOD_ARGUMENT = r"[0-9-]{4,10}"
FIRST_YEAR, LAST_YEAR = 1900, 2100


def normalize_period(col: Column) -> Column:
    """``YYYY`` or ``YYYY-MM`` for comparison, null where the text is no period.

    One pattern serves all forms, so the text is looked at once: the forms exclude
    each other by length, and text of any other form leaves nothing.
    """
    kept = F.regexp_replace(strip_text(col), PERIOD_FORMS, "$1$2$3$4")
    return F.nullif(kept, F.lit(""))


def normalize_period_text(text: str) -> str | None:
    """Plan-time form of :func:`normalize_period` for bounds and column names."""
    text = text.strip(WHITESPACE)
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}", text):
        month_or_year = int(text[5:])
        if month_or_year == 0:
            return None
        return text if month_or_year <= 12 else text[:4]
    if len(text) >= 10 and text[4] == "-" and text[7] == "-":
        return text[:7]
    return text if re.fullmatch(r"[0-9]{4}", text) else None


def _bounds(start: str | None, end: str | None) -> tuple[str | None, str | None]:
    return (
        normalize_period_text(start) if start else None,
        normalize_period_text(end) if end else None,
    )


def period_in_range(col: Column, start: str | None, end: str | None) -> Column:
    """Rows whose period lies in the bounds; text that is no period passes.

    A year as end bound covers its months; a year as period is compared as text,
    so ``2024`` lies before ``2024-06``.
    """
    low, high = _bounds(start, end)
    if high is not None and len(high) == 4:
        high += "-99"  # sorts after the year itself and all of its months
    period = normalize_period(col)
    if low is not None and high is not None:
        inside = period.between(low, high)
    elif low is not None:
        inside = period >= low
    elif high is not None:
        inside = period <= high
    else:
        return F.lit(True)
    return F.coalesce(inside, F.lit(True))


def period_text_in_range(text: str, start: str | None, end: str | None) -> bool:
    """Plan-time form of :func:`period_in_range`, used on column names."""
    period = normalize_period_text(text)
    if period is None:
        return True
    low, high = _bounds(start, end)
    if low is not None and period < low:
        return False
    if high is not None and len(high) == 4:
        high += "-99"
    return high is None or period <= high


def check_period(value: object, name: str = "period") -> str | None:
    """Validate a period argument: a year as int, or text of digits and dashes."""
    if value is None:
        return None
    if isinstance(value, bool):
        raise ValueError(f"{name} must be text or a year as int, not bool")
    if isinstance(value, int):
        if not FIRST_YEAR <= value <= LAST_YEAR:
            raise ValueError(f"{name} integer {value} out of range {FIRST_YEAR}-{LAST_YEAR}")
        return str(value)
    if not isinstance(value, str):
        raise ValueError(f"{name} must be text or a year as int, not {type(value).__name__}")
    text = value.strip()
    if not text:
        return None
    if not re.fullmatch(PERIOD_ARGUMENT, text):
        raise ValueError(f"{name} {value!r} has invalid format; use YYYY, YYYY-MM or YYYY-MM-DD")
    return text


def check_period_range(start: object, end: object) -> tuple[str | None, str | None]:
    low, high = check_period(start, "start_period"), check_period(end, "end_period")
    if low and high and low > high:
        raise ValueError(f"end_period ({high}) is before start_period ({low})")
    return low, high


def date_bounds(start: object, end: object) -> tuple[dt.date | None, dt.date | None]:
    """First and last day covered by two partial bounds, both inclusive."""
    low, high = check_period_range(start, end)

    def day(text: str, last: bool) -> dt.date:
        parts = [int(p) for p in text.split("-") if p]
        if not 1 <= len(parts) <= 3 or len(text.split("-")[0]) != 4:
            raise ValueError(f"date bound {text!r} must be YYYY, YYYY-MM or YYYY-MM-DD")
        year = parts[0]
        month = parts[1] if len(parts) > 1 else (12 if last else 1)
        if len(parts) > 2:
            return dt.date(year, month, parts[2])
        return dt.date(year, month, calendar.monthrange(year, month)[1] if last else 1)

    return (day(low, False) if low else None, day(high, True) if high else None)
