"""State and territory names, ISO 3166-2 codes and postcodes to one short code."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from musterroll.functions.cleaning import strip_text

# The eight state and territory codes, the names they go by, and
# the published postcode ranges (inclusive).
STATE_NAMES = {
    "NSW": ("new south wales",),
    "VIC": ("victoria",),
    "QLD": ("queensland",),
    "SA": ("south australia",),
    "WA": ("western australia",),
    "TAS": ("tasmania", "tassie"),
    "NT": ("northern territory",),
    "ACT": ("australian capital territory",),
}
POSTCODE_RANGES = (
    ("ACT", 200, 299),
    ("NT", 800, 999),
    ("NSW", 1000, 2599),
    ("ACT", 2600, 2618),
    ("NSW", 2619, 2899),
    ("ACT", 2900, 2920),
    ("NSW", 2921, 2999),
    ("VIC", 3000, 3999),
    ("QLD", 4000, 4999),
    ("SA", 5000, 5999),
    ("WA", 6000, 6797),
    ("WA", 6800, 6999),
    ("TAS", 7000, 7999),
    ("VIC", 8000, 8999),
    ("QLD", 9000, 9999),
)

STATE_KEYS = frozenset({"state", "region", "state_territory"})


def state_spellings() -> dict[str, str]:
    """Every accepted lower-case spelling and the code it stands for."""
    return {
        spelling: code
        for code, names in STATE_NAMES.items()
        for spelling in (code.lower(), f"au-{code.lower()}", *names)
    }


def state_enum() -> dict[str, str]:
    """Alias map used by every register: ``nsw`` and ``NSW`` both mean ``NSW``."""
    return {code.lower(): code for code in STATE_NAMES} | {code: code for code in STATE_NAMES}


def normalize_region_text(text: str) -> str | None:
    """Plan-time form of :func:`normalize_region`, used on filter values."""
    text = text.strip().lower()
    if re.fullmatch(r"[0-9]{4}", text):
        number = int(text)
        return next((c for c, lo, hi in POSTCODE_RANGES if lo <= number <= hi), None)
    return state_spellings().get(text)


def normalize_region(col: Column) -> Column:
    """State code for a column of codes, names, ISO codes or postcodes.

    The whole mapping is a literal in the plan, so no table is joined.
    """
    text = F.lower(strip_text(col))
    postcode = F.when(text.rlike(r"^[0-9]{4}$"), text.try_cast("int"))
    spellings = F.create_map(
        *[F.lit(x) for x in chain.from_iterable(state_spellings().items())]
    )
    by_postcode = F.coalesce(
        *[F.when(postcode.between(lo, hi), F.lit(code)) for code, lo, hi in POSTCODE_RANGES]
    )
    return F.coalesce(by_postcode, F.try_element_at(spellings, text))
