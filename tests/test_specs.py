import dataclasses
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from musterroll import REGISTERS, Catalog, TableSpec
from musterroll.functions.regions import STATE_NAMES
from musterroll.specs import columns
from musterroll.specs.loading import load_folder, spec_from_mapping
from musterroll.specs.model import normalize_id
from musterroll.specs.tables import LINEITEM, SAMPLE_TABLES

CATALOG = Catalog(REGISTERS)


def test_thirteen_registers_sorted_by_id():
    assert len(CATALOG.ids()) == 13
    assert CATALOG.ids() == sorted(CATALOG.ids())
    assert [s.id for s in CATALOG.specs()] == CATALOG.ids()
    assert sum(len(s.columns) for s in CATALOG.specs()) == 160


@pytest.mark.parametrize("spec", REGISTERS + SAMPLE_TABLES, ids=lambda s: s.id)
def test_spec_contract(spec):
    spec.validate()
    assert spec.keywords
    for key, enum in spec.enums.items():
        # every source value is also an alias of itself, unless a sample table says otherwise
        if spec in REGISTERS:
            assert set(enum.values()) <= set(enum)
        assert spec.column(key).role == "dimension"


@pytest.mark.parametrize("spec", [s for s in REGISTERS if "state" in s.enums], ids=lambda s: s.id)
def test_state_enum_is_complete(spec):
    assert set(spec.enums["state"].values()) == set(STATE_NAMES)
    assert len(spec.enums["state"]) == 16


def test_register_rows_and_roles():
    short = CATALOG.get("SHORT_POSITIONS")
    assert short.measure_keys == [
        "reported_short_positions", "total_product_in_issue", "short_percent",
    ]
    advisers = CATALOG.get("FINANCIAL_ADVISERS")
    assert advisers.measure_keys == []
    assert advisers.dimension_keys[-1] == "adviser_number"
    assert [f.metadata["role"] for f in advisers.schema()][2] == "id"


@given(st.sampled_from(CATALOG.ids()), st.sampled_from([str.lower, str.title, str.upper]), st.text(" \t", max_size=3))
def test_ids_in_any_case(table_id, case, pad):
    assert CATALOG.get(pad + case(table_id) + pad).id == table_id


@given(st.text("ABCXYZ", min_size=1, max_size=6), st.sampled_from(CATALOG.ids()))
def test_only_the_catalogues_own_prefixes_count(prefix, table_id):
    assert CATALOG.find(f"{prefix}_{table_id}") is None or f"{prefix}_{table_id}" in CATALOG.ids()
    own = Catalog(REGISTERS, prefixes=[prefix])
    assert own.get(f"{prefix.lower()}_{table_id}").id == table_id
    assert f"{prefix.lower()}-companies" in own.packages(own.get("COMPANIES"))


@given(st.one_of(st.none(), st.integers(), st.floats(), st.binary(), st.lists(st.text()), st.dictionaries(st.text(), st.text())))
def test_id_must_be_text(bad):
    with pytest.raises(ValueError, match="must be a string"):
        CATALOG.get(bad)


@given(st.text(max_size=12))
def test_id_characters(text):
    shape = text.strip().upper()
    if shape and shape.isascii() and shape[0].isalpha() and shape.replace("_", "a").isalnum():
        assert normalize_id(text) == shape
    else:
        with pytest.raises(ValueError, match="invalid characters|empty"):
            normalize_id(text)


def test_unknown_id_names_the_closest():
    with pytest.raises(ValueError, match="Did you mean 'COMPANIES'"):
        CATALOG.get("COMPANYES")
    assert CATALOG.find("DEFINITELY_NOT_A_TABLE") is None


@pytest.mark.parametrize(
    "value, code",
    [
        ("nsw", "NSW"), ("NSW", "NSW"), ("Nsw", "NSW"), ("New South Wales", "NSW"),
        ("queensland", "QLD"), ("AU-VIC", "VIC"), ("Tassie", "TAS"), ("Victoria", "VIC"),
        ("2000", "NSW"), ("2600", "ACT"), ("3000", "VIC"), ("0800", "NT"),
    ],
)
def test_state_values(value, code):
    assert CATALOG.get("FINANCIAL_ADVISERS").translate("state", value) == code


def test_translation():
    companies = CATALOG.get("COMPANIES")
    assert companies.translate("status", "active") == "REGD"
    assert companies.translate("status", "DRGD") == "DRGD"
    assert CATALOG.get("AFS_LICENSEE").translate("licensee_name", "Any Bank") == "Any Bank"
    with pytest.raises(ValueError, match="no value 'wakanda'"):
        CATALOG.get("FINANCIAL_ADVISERS").translate("state", "wakanda")
    with pytest.raises(ValueError, match="Did you mean 'registered'"):
        companies.translate("status", "registred")


def test_measures():
    short = CATALOG.get("SHORT_POSITIONS")
    assert short.resolve_measures(None) == short.measure_keys
    asked = ["short_percent", "Reported Short Positions", "short_percent"]
    assert short.resolve_measures(asked) == ["short_percent", "reported_short_positions"]
    assert short.resolve_measures("short_percent") == ["short_percent"]
    assert CATALOG.get("LIQUIDATOR").resolve_measures(None) == []
    with pytest.raises(ValueError, match="non-empty list"):
        short.resolve_measures([])
    with pytest.raises(ValueError, match="no measure ''"):
        short.resolve_measures(["  "])
    with pytest.raises(ValueError, match="Did you mean 'short_percent'"):
        short.resolve_measures("short_precent")
    with pytest.raises(ValueError, match="none at all"):
        CATALOG.get("LIQUIDATOR").resolve_measures("alien")
    with pytest.raises(ValueError, match="give a measure"):
        short.resolve_measures({"a": 1})


def test_filter_keys():
    with pytest.raises(ValueError, match="Did you mean 'state'"):
        CATALOG.get("LIQUIDATOR").check_filter_key("stat")
    with pytest.raises(ValueError, match="cannot be filtered"):
        LINEITEM.check_filter_key("price")


@pytest.mark.parametrize(
    "change, message",
    [
        (dict(columns=columns("a  id  string  A\na  id  string  B")), "keys repeat"),
        (dict(columns=columns("a  id  string  A\nb  id  string  A")), "source columns repeat"),
        (dict(layout="tall"), "layout must be"),
        (dict(layout="transposed"), "metric label"),
        (dict(enums={"nope": {}}), "'nope' is not a column"),
        (dict(natural_key=("nope",)), "'nope' is not a column"),
        (dict(unit_column="nope"), "unit column"),
    ],
)
def test_contradictory_specs(change, message):
    good = TableSpec(id="T", name="t", columns=columns("a  id  string  A"))
    with pytest.raises(ValueError, match=message):
        dataclasses.replace(good, **change).validate()


def test_catalog_rejects_duplicates_and_bad_columns():
    spec = TableSpec(id="T", name="t", columns=columns("a  id  string  A"))
    with pytest.raises(ValueError, match="duplicate"):
        Catalog([spec, spec])
    with pytest.raises(ValueError, match="role"):
        columns("a  thing  string  A")
    with pytest.raises(ValueError, match="dtype"):
        columns("a  id  colour  A")


def test_materialised_spec_reads_friendly_names():
    spec = CATALOG.get("COMPANIES").materialised().validate()
    assert {c.source for c in spec.columns} == {c.key for c in spec.columns}
    assert {c.dtype for c in spec.columns} == {"native"}


MAPPING = {
    "id": "SHEETS",
    "name": "Sheets",
    "format": "CSV",
    "layout": "wide",
    "update_frequency": "monthly",
    "search_keywords": ["sheets"],
    "header_row": 3,
    "max_rows": 2,
    "columns": {
        "code": {"source_column": "Code", "role": "id"},
        "start_date": {"source_column": "Start", "role": "dimension", "dtype": "string"},
        "state": {"source_column": "State", "role": "dimension"},
        "amount": {"source_column": "Amount", "dtype": "int", "unit": "AUD"},
    },
    "dimension_values": {"state": {"nsw": "NSW"}, "code": None},
}


def test_spec_from_a_mapping(tmp_path):
    spec = spec_from_mapping(MAPPING)
    assert [c.dtype for c in spec.columns] == ["string", "date", "string", "long"]
    assert spec.measure_keys == ["amount"] and spec.enums == {"state": {"nsw": "NSW"}}
    assert (spec.cadence, spec.header_row, spec.max_rows) == ("monthly", 3, 2)
    (tmp_path / "sheets.json").write_text(json.dumps(MAPPING))
    catalog = load_folder(tmp_path, Catalog(REGISTERS))
    assert catalog.get("sheets") == spec and len(catalog.ids()) == 14
    (tmp_path / "again.json").write_text(json.dumps(MAPPING))
    with pytest.raises(ValueError, match="duplicate"):
        load_folder(tmp_path)


@pytest.mark.parametrize(
    "change, message",
    [
        ({"format": "pdf"}, "format must be"),
        ({"format": "xlsx"}, "format must be"),
        ({"layout": "tall"}, "layout must be"),
        ({"discovery": "x"}, "discovery must be"),
        ({"columns": {"a": "b"}}, "must be a mapping"),
        ({"columns": {"a": {"role": "id"}}}, "does not say its 'source_column'"),
        ({"columns": {"a": {"source_column": "A", "dtype": "blob"}}}, "dtype must be"),
        ({"dimension_values": {"state": ["nsw"]}}, "must be a mapping"),
    ],
)
def test_bad_mappings(change, message):
    with pytest.raises(ValueError, match=message):
        spec_from_mapping(MAPPING | change)
    with pytest.raises(ValueError, match="must be a mapping"):
        spec_from_mapping([1])
