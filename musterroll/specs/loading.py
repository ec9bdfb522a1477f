"""Specs from plain mappings and from spec files dropped into a folder."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Iterable, Mapping
from pathlib import Path

from musterroll.specs.model import Catalog, ColumnSpec, TableSpec

# Type names a spec file may use, and the file formats it may name.
DTYPE_NAMES = {
    "int": "long", "integer": "long", "long": "long",
    "float": "double", "number": "double", "double": "double",
    "string": "string", "str": "string", "date": "date", "native": "native",
}
FILE_FORMATS = ("csv",)


def _mapping(value: object, what: str) -> Mapping:
    if not isinstance(value, Mapping):
        raise ValueError(f"{what} must be a mapping, got {type(value).__name__}")
    return value


def _one_of(options: Collection[str], what: str) -> Callable[[object], str]:
    def read(value: object) -> str:
        if str(value).lower() not in options:
            raise ValueError(f"{what} must be one of {tuple(options)}, got {value!r}")
        return str(value).lower()

    return read


def _enums(value: object) -> dict[str, dict[str, str]]:
    """Alias maps per column; a column without one is free-form."""
    return {
        key: {str(alias): str(source) for alias, source in _mapping(enum, f"values of {key!r}").items()}
        for key, enum in _mapping(value, "dimension_values").items()
        if enum is not None
    }


def _columns(value: object) -> tuple[ColumnSpec, ...]:
    out = []
    for key, raw in _mapping(value, "columns").items():
        read = _read(raw, COLUMN_FIELDS, f"column {key!r}")
        if "source" not in read:
            raise ValueError(f"column {key!r} does not say its 'source_column'")
        read = {"role": "measure", "dtype": "string"} | read
        if read["dtype"] == "string" and key.endswith("_date"):
            read["dtype"] = "date"
        out.append(ColumnSpec(key, **read))
    return tuple(out)


def _same(value: object) -> object:
    return value


# Name in the file, name in the spec, how its value is read.
COLUMN_FIELDS = (
    ("source_column", "source", str),
    ("role", "role", str),
    ("dtype", "dtype", lambda v: DTYPE_NAMES[_one_of(DTYPE_NAMES, "dtype")(v)]),
    ("unit", "unit", _same),
    ("description", "description", _same),
)
SPEC_FIELDS = (
    ("id", "id", str),
    ("name", "name", str),
    ("columns", "columns", _columns),
    ("dimension_values", "enums", _enums),
    ("description", "description", _same),
    ("layout", "layout", lambda v: str(v).lower()),
    ("update_frequency", "cadence", _same),
    ("cache_kind", "cache_kind", _same),
    ("period_coverage", "period_coverage", _same),
    ("search_keywords", "keywords", tuple),
    ("natural_key", "natural_key", tuple),
    ("truncate", "truncate", dict),
    ("streaming", "large", bool),
    ("header_row", "header_row", _same),
    ("data_start_row", "data_start_row", _same),
    ("max_rows", "max_rows", _same),
    ("metric_label_column", "metric_label", _same),
    ("unit_column", "unit_column", _same),
    ("discovery", "discovery", lambda v: _mapping(v, "discovery")),
    ("url_template", "file_template", _same),
    ("url_template_lookback_days", "lookback_days", _same),
    ("download_url", "default_url", _same),
    ("source_url", "source_page", _same),
)


def _read(raw: object, fields: Iterable[tuple], what: str) -> dict:
    raw = _mapping(raw, what)
    return {target: read(raw[name]) for name, target, read in fields if raw.get(name) is not None}


def spec_from_mapping(raw: object) -> TableSpec:
    """A checked spec from the mapping a spec file holds."""
    _one_of(FILE_FORMATS, "format")(_mapping(raw, "a spec").get("format") or "csv")
    read = {"columns": ()} | _read(raw, SPEC_FIELDS, "a spec")
    return TableSpec(multiline=not read.get("large", False), **read).validate()


def load_folder(folder: str | Path, catalog: Catalog | None = None) -> Catalog:
    """Register every spec file of a folder (JSON; YAML where a YAML reader is installed)."""
    catalog = Catalog() if catalog is None else catalog
    for path in sorted(Path(folder).iterdir()):
        if path.suffix == ".json":
            catalog.register(spec_from_mapping(json.loads(path.read_text(encoding="utf-8"))))
        elif path.suffix in (".yaml", ".yml"):
            try:
                import yaml
            except ImportError as error:
                raise ValueError(f"{path.name}: no YAML reader is installed, use JSON") from error
            catalog.register(spec_from_mapping(yaml.safe_load(path.read_text(encoding="utf-8"))))
    return catalog
