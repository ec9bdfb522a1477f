"""Declarative table specs: which source columns a table has and what they mean."""

from __future__ import annotations

import dataclasses
import difflib
import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

from musterroll.functions.regions import (
    STATE_KEYS,
    STATE_NAMES,
    normalize_region_text,
    state_spellings,
)

# The shape of a table id, the column roles, types and layouts.
TABLE_ID_PATTERN = r"[A-Z][A-Z0-9_]*"
ROLES = ("id", "dimension", "measure")
LAYOUTS = ("wide", "transposed")
DTYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.StringType(),
    "native": None,
}


@dataclass(frozen=True)
class ColumnSpec:
    """One exposed column.

    ``date`` columns hold ISO text; ``native`` columns keep the type they have
    in the table, which keeps their filters pushable to the scan.
    """

    key: str
    role: str
    source: str
    dtype: str = "string"
    unit: str | None = None
    description: str | None = None

    def __post_init__(self):
        if self.role not in ROLES:
            raise ValueError(f"column {self.key!r}: role must be one of {ROLES}")
        if self.dtype not in DTYPES:
            raise ValueError(f"column {self.key!r}: dtype must be one of {tuple(DTYPES)}")

    @property
    def label(self) -> str:
        return self.description or self.key.replace("_", " ").capitalize()


def columns(text: str) -> tuple[ColumnSpec, ...]:
    """Column specs from aligned lines ``key  role  dtype  source[  unit]``."""
    out = []
    for line in text.strip().splitlines():
        key, role, dtype, source, *unit = re.split(r"\s{2,}", line.strip())
        out.append(ColumnSpec(key, role, source, dtype, unit[0] if unit else None))
    return tuple(out)


def closest(word: str, options: Iterable[str], n: int = 1, cutoff: float = 0.6) -> list[str]:
    """Closest names among plan-time options (spec keys, aliases, ids)."""
    return difflib.get_close_matches(word, list(options), n=n, cutoff=cutoff)


def hint_for(word: str, options: Iterable[str]) -> str:
    near = closest(word, options)
    return f"Did you mean {near[0]!r}? " if near else ""


def some(options: Iterable[str], limit: int = 10) -> str:
    options = list(options)
    return ", ".join(options[:limit]) + ("..." if len(options) > limit else "")


def normalize_id(table_id: object) -> str:
    """Strip, upper-case and check a table id."""
    if not isinstance(table_id, str):
        raise ValueError(f"table id must be a string, got {type(table_id).__name__}")
    text = table_id.strip().upper()
    if not text:
        raise ValueError("table id is empty")
    if not re.fullmatch(TABLE_ID_PATTERN, text):
        raise ValueError(f"table id {table_id!r} contains invalid characters")
    return text


@dataclass(frozen=True)
class TableSpec:
    id: str
    name: str
    columns: tuple[ColumnSpec, ...]
    description: str = ""
    layout: str = "wide"
    cadence: str | None = None
    cache_kind: str = "data"
    period_coverage: str | None = None
    keywords: tuple[str, ...] = ()
    enums: dict[str, dict[str, str]] = field(default_factory=dict)
    natural_key: tuple[str, ...] = ()
    truncate: dict[str, int] = field(default_factory=dict)
    large: bool = False
    multiline: bool = True
    header_row: int = 1
    data_start_row: int | None = None
    max_rows: int | None = None
    metric_label: str | None = None
    unit_column: str | None = None
    discovery: dict[str, str] | None = None
    file_template: str | None = None
    lookback_days: int = 10
    default_url: str | None = None
    source_page: str | None = None

    # -- columns by role ---------------------------------------------------

    def with_role(self, *roles: str) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.role in roles)

    @property
    def dimension_keys(self) -> list[str]:
        """Dimension keys first, then id keys: the order of an observation's map."""
        return [c.key for c in self.with_role("dimension")] + [c.key for c in self.with_role("id")]

    @property
    def measure_keys(self) -> list[str]:
        return [c.key for c in self.with_role("measure")]

    def column(self, key: str) -> ColumnSpec:
        for c in self.columns:
            if c.key == key:
                return c
        raise KeyError(key)

    def key_of(self, source: str) -> str:
        for c in self.columns:
            if c.source == source:
                return c.key
        raise ValueError(f"table {self.id!r} has no column for source {source!r}")

    def substring_keys(self) -> frozenset[str]:
        """Columns matched by substring: ids, and dimensions without an enum."""
        return frozenset(
            c.key
            for c in self.with_role("id", "dimension")
            if c.role == "id" or c.key not in self.enums
        )

    def schema(self) -> T.StructType:
        """The friendly schema, with role, unit and source as field metadata."""
        return T.StructType(
            [
                T.StructField(
                    c.key,
                    DTYPES[c.dtype] or T.StringType(),
                    True,
                    {"role": c.role, "unit": c.unit or "", "source": c.source},
                )
                for c in self.columns
            ]
        )

    def materialised(self) -> TableSpec:
        """The spec of this table once written out clean under friendly names."""
        cols = tuple(
            dataclasses.replace(c, source=c.key, dtype="native") for c in self.columns
        )
        label = self.key_of(self.metric_label) if self.metric_label else None
        unit = self.key_of(self.unit_column) if self.unit_column else None
        return dataclasses.replace(self, columns=cols, metric_label=label, unit_column=unit)

    # -- plan-time checks --------------------------------------------------

    def validate(self) -> TableSpec:
        """Raise where the spec contradicts itself."""
        normalize_id(self.id)
        problems = []
        keys = [c.key for c in self.columns]
        sources = [c.source for c in self.columns]
        if len(set(keys)) < len(keys):
            problems.append("column keys repeat")
        if len(set(sources)) < len(sources):
            problems.append("source columns repeat")
        if self.layout not in LAYOUTS:
            problems.append(f"layout must be one of {LAYOUTS}")
        if self.layout == "transposed" and self.metric_label not in sources:
            problems.append("a transposed table needs a metric label column")
        if self.unit_column and self.unit_column not in sources:
            problems.append("the unit column is not declared")
        for where in (self.enums, self.truncate, self.natural_key):
            problems += [f"{k!r} is not a column" for k in where if k not in keys]
        if problems:
            raise ValueError(f"table {self.id!r}: " + "; ".join(problems))
        return self

    def check_filter_key(self, key: str) -> str:
        """Only id and dimension columns can be filtered."""
        allowed = {c.key for c in self.with_role("id", "dimension")}
        if key in allowed:
            return key
        raise ValueError(
            f"{self.id} cannot be filtered by {key!r}. {hint_for(key, sorted(allowed))}"
            f"It can by: {some(sorted(allowed))}"
        )

    @functools.cached_property
    def accepted(self) -> dict[str, dict[str, str]]:
        """Per column every accepted spelling of a value and the source value it stands for."""
        tables: dict[str, dict[str, str]] = {}
        for key in {c.key for c in self.columns} & (STATE_KEYS | set(self.enums)):
            enum = self.enums.get(key)
            table = tables[key] = {}
            if key in STATE_KEYS:
                sources = {v.upper(): v for v in (enum or dict.fromkeys(STATE_NAMES)) if v.upper() in STATE_NAMES}
                sources |= {v.upper(): v for v in (enum or {}).values()}
                table |= {s: sources[code] for s, code in state_spellings().items() if code in sources}
            table |= {v: v for v in (enum or {}).values()} | (enum or {})
        return tables

    def translate(self, key: str, value: str) -> str:
        """The source value that a filter value stands for.

        Columns without accepted spellings take any value as it is; region columns also
        take names, ISO codes and postcodes in any case.
        """
        table = self.accepted.get(key)
        if table is None:
            return value
        region = (value.strip().lower(), (normalize_region_text(value) or "").lower())
        spellings = (value, *region) if key in STATE_KEYS else (value,)
        found = next((table[s] for s in spellings if s in table), None)
        if found is None and key in self.enums:
            raise ValueError(
                f"{key} of {self.id} has no value {value!r}. {hint_for(value, sorted(table))}"
                f"It has: {some(sorted(self.enums[key]))}"
            )
        return value if found is None else found

    def metric_enum(self) -> dict[str, str] | None:
        """Alias map of the metric labels of a transposed table."""
        if self.metric_label is None:
            return None
        return self.enums.get(self.key_of(self.metric_label))

    @functools.cached_property
    def measure_names(self) -> dict[str, str]:
        """Every name a measure can be asked for by, and its key, in spec order."""
        if self.layout == "transposed" and not self.measure_keys:
            return {alias: alias for alias in self.metric_enum() or ()}
        keys = {k: k for k in self.measure_keys}
        return keys | {c.source: c.key for c in self.with_role("measure") if c.source not in keys}

    def resolve_measures(self, requested: str | list[str] | None = None) -> list[str]:
        """Keys of the measures asked for, in the order asked, once each; all by default."""
        names = self.measure_names
        if requested is None:
            return list(dict.fromkeys(names.values()))
        asked = [requested] if isinstance(requested, str) else requested
        if not isinstance(asked, list) or not asked:
            raise ValueError("give a measure, a non-empty list of them, or nothing for all")
        asked = [str(a).strip() for a in asked]
        for name in asked:
            if name not in names:
                offer = f"It has: {some(names)}" if names else "It has none at all."
                raise ValueError(f"{self.id} has no measure {name!r}. {hint_for(name, names)}{offer}")
        return list(dict.fromkeys(names[a] for a in asked))


class Catalog:
    """The tables an engine knows, by id.

    ``prefixes`` are publishers' names that may stand before an id (``PUB_COMPANIES``) and
    do stand before their package ids on a portal (``pub-companies``).
    """

    def __init__(self, specs: Iterable[TableSpec] = (), prefixes: Iterable[str] = ()):
        self._specs: dict[str, TableSpec] = {}
        self.prefixes = tuple(p.strip().upper() for p in prefixes)
        for spec in specs:
            self.register(spec)

    def register(self, spec: TableSpec) -> None:
        spec.validate()
        if spec.id in self._specs:
            raise ValueError(f"duplicate table id {spec.id!r}")
        self._specs[spec.id] = spec

    def ids(self) -> list[str]:
        return sorted(self._specs)

    def specs(self) -> list[TableSpec]:
        return [self._specs[i] for i in self.ids()]

    def find(self, table_id: str) -> TableSpec | None:
        """Spec by id in any case, with or without one of the catalogue's prefixes."""
        text = table_id.strip().upper()
        forms = [text, *(text.removeprefix(f"{p}_") for p in self.prefixes)]
        return next((self._specs[f] for f in forms if f in self._specs), None)

    def packages(self, spec: TableSpec) -> list[str]:
        """Portal package ids of a table: as declared, and under each prefix."""
        name = (spec.discovery or {}).get("package")
        return [name, *(f"{p.lower()}-{name}" for p in self.prefixes)] if name else []

    def get(self, table_id: object) -> TableSpec:
        text = normalize_id(table_id)
        spec = self.find(text)
        if spec is None:
            raise ValueError(
                f"Table {table_id!r} is not in the catalogue. {hint_for(text, self.ids())}"
                f"Valid options: {', '.join(self.ids())}"
            )
        return spec
