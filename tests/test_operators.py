import dataclasses
import difflib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from musterroll import REGISTERS, Catalog, Engine, TableSpec
from musterroll.functions import similarity as S
from musterroll.operators import audit, filters, joins, lookup, reshape, search, snapshots, summaries, topk
from musterroll.operators.project import coercion_report, project
from musterroll.plans import catalog as cat
from musterroll.specs import columns
from musterroll.specs.registers import AFS_LICENSEE, SHORT_POSITIONS, TRUNCATION_SUFFIX

SPEC = TableSpec(
    id="THINGS",
    name="Things",
    columns=columns("""
        code    id         string  Code
        state   dimension  string  State
        kind    dimension  string  Kind
        seen    dimension  date    Seen
        amount  measure    long    Amount   AUD
        share   measure    double  % Share  Per cent
    """),
    enums={"state": {"nsw": "NSW", "vic": "VIC", "NSW": "NSW", "VIC": "VIC"}},
    natural_key=("code",),
)
ROWS = [
    ("001", " NSW ", "Old Bolt", "01/02/2020", "10", "1.5", "dropped"),
    ("002", "VIC", "new BOLT*", "2020-03-04", "x", "2.5", "dropped"),
    ("003", "NSW", None, "Permanent", "12.0", "nan", "dropped"),
    ("004", "null", "", "", "", "", "dropped"),
]


@pytest.fixture(scope="module")
def raw(spark):
    names = ["Code", "State", "Kind", "Seen", "Amount", "% Share", "Extra"]
    return spark.createDataFrame(ROWS, ", ".join(f"`{n}` string" for n in names))


@pytest.fixture(scope="module")
def things(raw):
    return project(raw, SPEC)


def codes(df):
    return sorted(r["code"] for r in df.collect())


# -- projection ----------------------------------------------------------------


def test_projection(things):
    assert things.columns == ["code", "state", "kind", "seen", "amount", "share"]
    got = {r["code"]: r for r in things.collect()}
    assert got["001"]["state"] == "NSW" and got["001"]["seen"] == "2020-02-01"
    assert got["002"]["amount"] is None and got["003"]["amount"] == 12
    assert got["003"]["share"] is None and got["003"]["seen"] == "Permanent"
    assert got["004"]["state"] is None and got["004"]["kind"] is None
    assert things.schema["amount"].metadata["unit"] == "AUD"


def test_projection_of_typed_columns(spark):
    df = spark.sql(
        "SELECT 7L AS Code, 'NSW' AS State, 2.0D AS Kind, DATE '2020-01-02' AS Seen, "
        "3 AS Amount, double('nan') AS `% Share`"
    )
    assert tuple(project(df, SPEC).head()) == ("7", "NSW", "2", "2020-01-02", 3, None)


def test_coercion_report(raw):
    got = {r["key"]: (r["filled"], r["failed"]) for r in coercion_report(raw, SPEC).collect()}
    assert got == {"amount": (3, 1), "share": (3, 1)}


# -- filters -------------------------------------------------------------------


@pytest.mark.parametrize(
    "wanted, kept",
    [
        (None, ["001", "002", "003", "004"]),
        ({"state": "nsw"}, ["001", "003"]),
        ({"state": "New South Wales"}, ["001", "003"]),
        ({"state": "2000"}, ["001", "003"]),
        ({"state": ["vic", "NSW"]}, ["001", "002", "003"]),
        ({"kind": "bolt"}, ["001", "002"]),
        ({"kind": "*BoLt~"}, ["001", "002"]),
        ({"kind": ["Old Bolt"]}, ["001"]),
        ({"kind": ["old bolt"]}, []),
        ({"code": 2}, ["002"]),
        ({"code": ["2"]}, []),
        ({"state": "nsw", "kind": "old"}, ["001"]),
        ('{"state": "vic"}', ["002"]),
        ({"kind": "%"}, []),
        ({"kind": "' OR 1=1 --"}, []),
    ],
)
def test_filters(things, wanted, kept):
    assert codes(filters.apply_filters(things, SPEC, wanted)) == kept


@pytest.mark.parametrize(
    "wanted, message",
    [
        ({"stat": "nsw"}, "Did you mean 'state'"),
        ({"amount": 3}, "cannot be filtered"),
        ({"state": []}, "empty list"),
        ({"state": "mars"}, "has no value"),
        ({"kind": "**~"}, "nothing left"),
        ({"kind": " "}, "nothing left"),
        ("not json", "invalid JSON"),
        ("[1]", "must be a dict"),
        (42, "must be a dict"),
        (["state"], "must be a dict"),
    ],
)
def test_bad_filters(things, wanted, message):
    with pytest.raises(ValueError, match=message):
        filters.apply_filters(things, SPEC, wanted)


def test_integer_columns_compare_as_text_but_push_down(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("int").alias("Code")).write.parquet(str(tmp_path / "t"))
    spec = TableSpec(id="N", name="n", columns=columns("code  id  native  Code"))
    df = project(spark.read.parquet(str(tmp_path / "t")), spec)
    kept = filters.apply_filters(df, spec, {"code": ["7", "08", "x", "9" * 30, "-0", "12"]})
    assert codes(kept) == [7, 12]
    assert "PushedFilters: [In(Code, [" in kept._jdf.queryExecution().executedPlan().toString()
    assert codes(filters.apply_filters(df, spec, {"code": ["x"]})) == []
    assert codes(filters.apply_filters(df, spec, {"code": "99"})) == [99]


def test_blank_rows(things):
    assert codes(filters.drop_blank_rows(things, ["state", "kind", "seen"])) == ["001", "002", "003"]
    assert codes(filters.drop_blank_rows(things, ["absent"])) == ["001", "002", "003", "004"]


def test_date_range_on_text(things):
    kept = filters.date_range(things, "seen", "2020-02", "2020-02")
    assert codes(kept) == ["001"]
    assert codes(filters.date_range(things, "seen", "2020", None)) == ["001", "002"]
    assert codes(filters.date_range(things, "seen", "2020", None, iso=True)) == ["001", "002"]
    assert filters.date_range(things, "seen").count() == 4


# -- reshaping -----------------------------------------------------------------


def test_wide_observations(things):
    got = reshape.wide_observations(things, SPEC).collect()
    assert sorted((r["measure"], r["value"], r["unit"], r["dimensions"]["code"]) for r in got) == [
        ("amount", 10.0, "AUD", "001"), ("amount", 12.0, "AUD", "003"),
        ("share", 1.5, "Per cent", "001"), ("share", 2.5, "Per cent", "002"),
    ]
    keys = reshape.wide_observations(things.where("code = '001'"), SPEC).select(F.map_keys("dimensions"))
    assert keys.head()[0] == ["state", "kind", "seen", "code"]  # dimensions, then ids
    assert "kind" not in next(r for r in got if r["dimensions"]["code"] == "003")["dimensions"]
    flat = reshape.wide_flat(things, SPEC, ["amount"])
    again = reshape.flatten(reshape.wide_observations(things, SPEC, ["amount"]), SPEC.dimension_keys)
    assert sorted(map(tuple, flat.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_register_without_measures(spark):
    spec = dataclasses.replace(SPEC, columns=SPEC.columns[:3])
    df = spark.createDataFrame(
        [("1", None, None), (None, None, None), (None, "NSW", "a")], "code string, state string, kind string"
    )
    got = reshape.wide_observations(df, spec).collect()
    assert sorted(sorted(r["dimensions"].items()) for r in got) == [
        [("code", "1")], [("kind", "a"), ("state", "NSW")],
    ]
    assert reshape.wide_flat(df, spec).count() == 2


SHEET = TableSpec(
    id="SHEET",
    name="Sheet",
    layout="transposed",
    metric_label="Metric",
    unit_column="Unit",
    columns=columns("""
        metric  dimension  string  Metric
        unit    dimension  string  Unit
    """),
    enums={"metric": {"net": "Net total", "net_total": "Net total", "gross": "Gross"}},
)


@pytest.fixture(scope="module")
def sheet(spark):
    rows = [
        ("Net total ", "AUD", "1", "2", "3", "4", "see note"),
        (" Gross", "AUD", "5", "n/a", None, "8", None),
        ("Staff", "Persons", "9", "10", "11", "12", None),
        (None, "AUD", "1", "1", "1", "1", None),
    ]
    names = ["Metric", "Unit", "2019", "2020-21", "2024-06", "2024-07-01 00:00:00", "note"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    return project(df, SHEET)


def cells(df):
    return sorted((r["measure"], r["period"], r["value"], r["unit"]) for r in df.collect())


def test_transposed(sheet):
    got = reshape.transposed_observations(sheet, SHEET)
    assert cells(got) == [
        ("gross", "2019", 5.0, "AUD"), ("gross", "2024-07-01 00:00:00", 8.0, "AUD"),
        ("net_total", "2019", 1.0, "AUD"), ("net_total", "2020-21", 2.0, "AUD"),
        ("net_total", "2024-06", 3.0, "AUD"), ("net_total", "2024-07-01 00:00:00", 4.0, "AUD"),
    ]
    assert {r["dimensions"]["metric_source_label"] for r in got.collect()} == {"Net total", "Gross"}


def test_transposed_choices(sheet):
    net = reshape.transposed_observations(sheet, SHEET, ["net"], "2020", "2024-06")
    assert cells(net) == [("net_total", "2020-21", 2.0, "AUD"), ("net_total", "2024-06", 3.0, "AUD")]
    free = dataclasses.replace(SHEET, enums={})
    assert {r[0] for r in cells(reshape.transposed_observations(sheet, free))} == {
        "Net total", "Gross", "Staff",
    }
    none = reshape.transposed_observations(sheet.drop("note"), SHEET, None, "2030")
    assert none.count() == 0 and none.columns == list(reshape.OBSERVATION)
    with pytest.raises(ValueError, match="no measure"):
        reshape.transposed_observations(sheet, SHEET, ["nope"])


def test_last_n(sheet):
    long = reshape.transposed_observations(sheet, SHEET)
    newest = [
        ("gross", "2024-07-01 00:00:00", 8.0, "AUD"), ("net_total", "2024-07-01 00:00:00", 4.0, "AUD"),
    ]
    assert cells(topk.last_n(long, 1)) == newest
    assert cells(topk.last_n(long, 1, has_periods=True)) == newest
    assert topk.last_n(long, 99).count() == 6
    bare = long.withColumn("period", F.lit(None).cast("string"))
    assert topk.last_n(bare, 1).count() == 6
    with pytest.raises(ValueError):
        topk.last_n(long, 0)


def test_engine_on_a_transposed_table(sheet, spark):
    rows = [("Net total ", "AUD", "1", "2")]
    df = spark.createDataFrame(rows, "Metric string, Unit string, `2019` string, `2024-06` string")
    engine = Engine(spark, Catalog([SHEET])).bind("SHEET", df)
    assert cells(engine.query("SHEET", start_period="2020")) == [("net_total", "2024-06", 2.0, "AUD")]
    assert cells(engine.latest("SHEET")) == [("net_total", "2024-06", 2.0, "AUD")]
    series = engine.query("SHEET", format="series").collect()
    assert [(r["measure"], r["unit"], r["chunk"]) for r in series] == [("net_total", "AUD", 0)]
    assert [o["period"] for o in series[0]["observations"]] == ["2019", "2024-06"]
    assert engine.query("SHEET", {"metric": "net"}, format="csv").columns[-1] == "metric_source_label"
    row = engine.summary("SHEET", end_period="2020").head()
    assert (row["row_count"], row["unit"], row["period_start"], row["period_end"]) == (
        1, "AUD", "2019", "2020",
    )
    for bad in ("xml", 3):
        with pytest.raises(ValueError):
            engine.query("SHEET", format=bad)
    with pytest.raises(ValueError, match="no data is bound"):
        Engine(spark, Catalog([SHEET])).query("SHEET")


def test_series_keeps_every_row_in_bounded_chunks(spark):
    """A measure with most rows, one month with most of those, many of them equal."""
    hot = [("hot", "2024-05", 1.0, "a")] * 700 + [("hot", "2024-05", float(i), "b") for i in range(300)]
    rest = [("hot", f"20{y}-01", 1.0, "c") for y in range(10, 40)] + [("cold", None, 5.0, "d")] * 3
    rows = hot + rest
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "measure string, period string, value double, k string")
    long = df.repartition(16, "value", "k", F.rand(3)).select(
        "period", "measure", "value", F.lit("u").alias("unit"),
        F.create_map(F.lit("k"), "k").alias("dimensions"),
    )
    got = reshape.series(long, chunk_rows=100).orderBy("measure", "chunk").collect()
    back = [
        (r["measure"], o["period"], o["value"], o["dimensions"]["k"])
        for r in got for o in r["observations"]
    ]
    assert sorted(back, key=str) == sorted(rows, key=str)
    periods = [p for m, p, _, _ in back if m == "hot"]
    assert periods == sorted(periods)
    assert max(len(r["observations"]) for r in got) < 400  # of 1030: no chunk holds the month
    assert [r["chunk"] for r in got if r["measure"] == "cold"] == [0]


def test_csv_lines(things):
    line = reshape.csv_lines(things.where("code = '002'").select("code", "kind", "seen")).head()[0]
    assert line == "002,new BOLT*,2020-03-04"


# -- summaries -----------------------------------------------------------------


def test_summary_row(things):
    long = reshape.wide_observations(things, SPEC)
    row = summaries.summary(long, SPEC, snapshot_date="2024-01-01", as_of="2024-01-31").head()
    assert row["row_count"] == 4 and row["unit"] is None and row["period_start"] is None
    assert row["stale"] is False and row["stale_reason"] is None  # no cadence, no rule
    weekly = dataclasses.replace(SPEC, cadence="weekly")
    row = summaries.summary(
        long.where("measure = 'share'"), weekly, "2019", None, snapshot_date="2024-01-01", as_of="2024-01-31"
    ).head()
    assert row["unit"] == "Per cent" and row["period_start"] == "2019" and row["stale"] is True
    assert row["stale_reason"] == "weekly snapshot is 30 days old, expected at most 14"
    empty = summaries.summary(long.where("false"), SPEC).head()
    assert empty["row_count"] == 0 and empty["unit"] is None


@pytest.mark.parametrize(
    "year, direction", [(2010, "BEFORE"), (2030, "AFTER"), (2021, "IN RANGE"), (2020, "FOUND")]
)
def test_year_hint(spark, year, direction):
    df = spark.createDataFrame([("2020",), ("2024",), ("n/a",), ("20",), (None,)], "y string")
    row = summaries.year_hint(df, "y", year).head()
    assert (row["first_year"], row["last_year"], row["direction"]) == (2020, 2024, direction)
    assert summaries.year_hint(df.where("y = 'n/a'"), "y", year).head()["direction"] is None


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 40])
def test_last_n_by_count_keeps_the_rows_of_a_ranking(spark, n):
    draw = random.Random(n)
    periods = [None, "2020", "2020-03", "Mar 2020", "2021-Q1", "", "n/a", "2021-11"]
    rows = [
        (draw.choice(periods), draw.choice([None, "", "m", "k"]), float(i % 7), None, {"i": str(i)}) for i in range(120)
    ]
    long = spark.createDataFrame(rows, reshape.observation_schema()).repartition(5)
    order = [F.to_json("dimensions")]
    key = lambda df: sorted(r["dimensions"]["i"] for r in df.collect())
    assert key(topk._newest_by_count(long, n, order)) == key(topk._keep_last(long, n, order))


def test_last_n_beyond_any_rank_limit(spark):
    long = spark.range(1_300_000, numPartitions=8).select(
        F.format_string("20%02d-%02d", F.col("id") % 24, F.col("id") % 12 + 1).alias("period"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 5)).alias("measure"),
        F.col("id").cast("double").alias("value"), F.lit("u").alias("unit"), F.create_map(F.lit("i"), F.col("id").cast("string")).alias("dimensions"),
    )
    kept = topk.last_n(long, 100_000, [F.col("value")], has_periods=True)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "_rank" in plan and plan.count("Window ") <= 6  # over counts and over rows of one period
    found = {r["measure"]: r for r in kept.groupBy("measure").agg(F.count("*").alias("n"), F.min("period").alias("low")).collect()}
    assert {r["n"] for r in found.values()} == {100_000} and len(found) == 6
    want = long.where("measure = 'hot'").orderBy(F.desc("period"), "value").limit(100_000)
    assert kept.where("measure = 'hot'").select("value").exceptAll(want.select("value")).isEmpty()
    assert topk.last_n(long, 1_000_000, [F.col("value")], has_periods=True).count() == 1_300_000


def test_last_n_by_count_gathers_no_measure(spark):
    """Rows stay where they are, and of a period with more than are wanted tasks keep their first."""
    long = spark.range(4_000, numPartitions=8).select(
        F.when(F.col("id") % 10 < 7, "2020-05").otherwise(F.format_string("20%02d", F.col("id") % 20)).alias("period"),
        F.lit("m").alias("measure"), F.col("id").cast("double").alias("value"), F.lit("u").alias("unit"),
        F.create_map(F.lit("i"), F.col("id").cast("string")).alias("dimensions"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the counts looked large
    try:
        kept = topk._newest_by_count(long, 150, [F.col("value")])
        got = sorted(r["value"] for r in kept.collect())
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "_group" in plan
    newest = sorted(long.collect(), key=lambda r: r["value"])
    newest.sort(key=lambda r: {"2020": "2020-01"}.get(r["period"], r["period"]), reverse=True)
    assert got == sorted(r["value"] for r in newest[:150])


def test_limits(spark):
    df = spark.range(30_000).repartition(7)
    got = topk.limited(df, ["id"], 5).collect()
    assert [r["id"] for r in got] == [0, 1, 2, 3, 4] and got[0]["truncated_at"] == 30_000
    big = topk.first_in_order(df, [F.col("id").desc()], 2_000).collect()
    assert [r["id"] for r in big] == list(range(29_999, 27_999, -1))
    assert topk.limited(df.limit(3), ["id"], 5).head()["truncated_at"] is None
    for bad in (0, -1, False, True, 1.5, "10", None, 10_001):
        with pytest.raises(ValueError):
            topk.limited(df, ["id"], bad)


_INF, _NAN = float("inf"), float("nan")


def test_tops_order_like_a_sort(spark):
    rows = [(1, 2.0), (2, None), (3, _NAN), (4, _INF), (5, -_INF), (6, -0.0), (7, 0.0), (8, 2.0), (9, None), (10, _NAN)]
    df = spark.createDataFrame(rows, "id bigint, v double").repartition(4)
    for column, kind in [("v", "double"), ("v", "float"), ("id", "bigint"), ("id", "int"), ("id", "decimal(9,2)")]:
        cast = df.withColumn("key", F.col("id")).withColumn(column, F.when(F.col("id") != 2, F.col(column)).cast(kind))
        want = [r["key"] for r in cast.orderBy(F.col(column).desc_nulls_last(), "key").collect()]
        for n in (1, 4, 10, 20):
            assert [r["key"] for r in topk.top_n(cast, column, n, ["key"]).collect()] == want[:n]
        up = [r["key"] for r in cast.orderBy(column, "key").collect()]
        assert [r["key"] for r in topk.first_in_order(cast, [column, "key"], 7).collect()] == up[:7]
    edge = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (None,), (0,)], "id bigint")
    assert [r[0] for r in topk.top_n(edge, "id", 4, []).collect()] == [2**63 - 1, 0, -(2**63), None]


def test_tops_carry_any_column(spark):
    df = spark.range(500, numPartitions=7).select(
        (F.col("id") % 10).alias("group"), "id", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"),
        F.array("id").alias("a.b"), F.lit(None).cast("string").alias("_key_0"), F.lit(1).alias("_row"),
    )
    got = topk.limited(df, ["group", "id"], 3)
    assert got.columns == [*df.columns, "truncated_at"] and got.schema["m"].dataType == df.schema["m"].dataType
    assert [(r["id"], r["m"], r["a.b"], r["truncated_at"]) for r in got.collect()] == [
        (i, {"k": str(i)}, [i], 500) for i in (0, 10, 20)
    ]
    # an order with a direction of its own, or text that falls, is ranked by windows
    assert [r["id"] for r in topk.limited(df, [F.col("id").desc()], 2).collect()] == [499, 498]
    names = df.select("id", F.format_string("n%03d", "id").alias("name"))
    assert [r["id"] for r in topk.top_n(names, "name", 2, []).collect()] == [499, 498]
    assert topk.limited(df.limit(0), ["id"], 3).collect() == []
    assert [r["truncated_at"] for r in topk.limited(df.limit(3), ["id"], 3).collect()] == [None] * 3


def test_tops_of_equal_rows(spark):
    df = spark.range(4000, numPartitions=9).select(F.lit(1).alias("v"), F.lit("x").alias("w"))
    got = topk.limited(df, ["v"], 1000).collect()
    assert len(got) == 1000 and got[0]["truncated_at"] == 4000


# -- lookups -------------------------------------------------------------------


def test_column_lookup(spark):
    df = spark.createDataFrame([("nsw",), ("VIC",), ("Tassie",), ("2000",), (None,)], "c string")
    enum = {"nsw": "NSW", "vic": "VIC", "NSW": "NSW", "VIC": "VIC"}
    plain = lookup.translate_column(F.col("c"), enum)
    region = lookup.translate_column(F.col("c"), enum, region=True)
    got = {r["c"]: (r["p"], r["r"]) for r in df.select("c", plain.alias("p"), region.alias("r")).collect()}
    assert got == {
        "nsw": ("NSW", "NSW"), "VIC": ("VIC", "VIC"), "Tassie": (None, None),
        "2000": (None, "NSW"), None: (None, None),
    }
    large = {str(i): f"x{i}" for i in range(3000)} | {"nsw": "x9"}
    found = df.select(lookup.translate_column(F.col("c"), large).alias("x")).collect()
    assert [r["x"] for r in found] == ["x9", None, None, "x2000", None]


def test_table_lookup_never_multiplies(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    table = spark.createDataFrame([("a", "2"), ("a", "1")], "alias string, code string")
    got = lookup.lookup_join(df, "c", table, "alias", "code", "into").collect()
    assert sorted(map(tuple, got), key=str) == [("a", "1"), ("b", None), (None, None)]


def test_last_alias_wins():
    assert lookup.reverse_enum({"x": "A", "y": "A", "z": "B"}) == {"A": "y", "B": "z"}


# -- joins ---------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_with_hot_and_null_keys(spark, how, broadcast):
    """A third of the rows share a key and are equal, another third have none."""
    left = (
        [("0007", "same")] * 300
        + [(None, f"n{i}") for i in range(300)]
        + [(f"{i:04d}", f"r{i}") for i in range(300)]
    )
    right = [("7", "seven"), ("8", "eight"), ("8", "eight again"), ("500", "far"), (None, "no key")]
    l_df = spark.createDataFrame(left, "k string, v string").repartition(8)
    r_df = spark.createDataFrame(right, "code string, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = joins.join_on_key(l_df, r_df, "k", "code", how)
        rows = sorted(map(str, got.select(*[c for c in ("k", "v", "code", "w") if c in got.columns]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    a = l_df.withColumn("x", F.col("k").cast("int"))
    b = r_df.withColumn("y", F.col("code").cast("int"))
    want = a.join(b, F.col("x") == F.col("y"), how).drop("x", "y")
    assert sorted(got.columns) == sorted(want.columns)
    assert rows == sorted(map(str, want.collect()))


def test_key_types_need_not_agree(spark):
    ints = spark.range(20).select(F.col("id").cast("int").alias("k"))
    longs = spark.range(5, 30).select(F.col("id").alias("code"))
    texts = longs.select(F.lpad(F.col("code").cast("string"), 6, "0").alias("code"))
    for right in (longs, texts):
        joined = joins.join_on_key(ints, right, "k", "code", "inner")
        assert sorted(r["k"] for r in joined.collect()) == list(range(5, 20))
    plain = joins.join_on_key(ints, texts, "k", "code", "inner", normalize=False)
    assert plain.count() == 0


def test_hot_rows_are_spread(spark):
    """Rows under one key, and rows without any, land in many tasks, and none is lost."""
    left = spark.range(0, 60_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "1").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    right = spark.range(0, 60_000).select(F.col("id").cast("string").alias("code"), F.lit("w").alias("w"))
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    try:
        joined = joins.join_on_key(left, right, "k", "code", "left").withColumn("p", F.spark_partition_id())
        per_task = [r["n"] for r in joined.groupBy("p").agg(F.count("*").alias("n"), F.max("v")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(per_task) == 60_000 and max(per_task) < 60_000 * 0.2
    with pytest.raises(ValueError, match="unsupported"):
        joins.join_on_key(left, right, "k", "code", "full")


def test_repeated_right_keys_never_multiply(spark):
    left = spark.createDataFrame([("0012", "a"), ("7", "b")], "k string, v string")
    right = spark.createDataFrame([("12", "late", "x"), ("012", "early", "y")], "k string, w string, v string")
    got = joins.enrich(left, right, "k", "k", ["w", "v"]).collect()
    assert sorted(map(tuple, got)) == [("0012", "a", "early"), ("7", "b", None)]


# -- search --------------------------------------------------------------------


def brute_relevance(rows, query, limit):
    """Scores by definition: (key, name, keywords, description) rows."""
    scored = []
    for key, name, keywords, description in rows:
        name, kw, text = name.lower(), keywords.lower(), (description or "").lower()
        first = S._plain_token_set(query, name)
        if len(query.split()) <= 2:
            first = max(first, S._plain_partial(query, name, 100.0))
        total = first + 0.4 * S._plain_token_set(query, kw) + (15 if query in kw else 0)
        total += 0.3 * min(30.0, S._plain_weighted(query, text, 100.0))
        scored.append((-total, -first, key))
    scored.sort()
    top = max(-scored[0][0], 100.0)
    return [(key, round(max(0.0, -total / top * 100), 1)) for total, _, key in scored[:limit]]


@pytest.mark.parametrize(
    "query", ["banned", "business name register", "credit licence", "auditor", "adviser " * 30, "<x> %00"]
)
def test_catalogue_search_against_brute_force(spark, query):
    catalog = Catalog(REGISTERS)
    rows = [
        (s.id, f"{s.id} {s.name}", f"{s.id} {s.name} {' '.join(s.keywords)}", s.description)
        for s in catalog.specs()
    ]
    got = [(r["id"], r["relevance"]) for r in cat.search(spark, catalog, query, 13).collect()]
    want = brute_relevance(rows, query.lower(), 13)
    assert sorted(got, key=lambda r: (-r[1], r[0])) == sorted(want, key=lambda r: (-r[1], r[0]))


@pytest.mark.parametrize("query", ["blue bolt", "ring", "bolt of the blue plate", "zq"])
def test_relevance_skips_no_hit(spark, query):
    draw = random.Random(query)
    vocabulary = ["blue", "bolt", "ring", "plate", "bl", "blues", "olt b", "of", "the", "tin", "ringer", "Blue Bolt"]
    text = lambda n: " ".join(draw.choices(vocabulary, k=draw.randrange(0, n)))
    rows = [(i, text(4), text(6), draw.choice([None, "", text(9)])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, name string, kw string, about string").repartition(3)
    for limit in (1, 7, 50):
        hits = search.relevance(df, query, F.col("name"), F.col("kw"), F.col("about"), limit=limit, tiebreak=["id"])
        got = [(r["id"], r["relevance"]) for r in hits.collect()]
        want = brute_relevance([(i, n, k, a) for i, n, k, a in rows], query, limit)
        assert sorted(r for _, r in got) == sorted(r for _, r in want)
        assert set(got) <= set(brute_relevance(rows, query, 120))  # scores that tie may swap by rounding
    few = search.relevance(df.limit(3), query, F.col("name"), F.col("kw"), limit=10, tiebreak=["id"])
    assert few.count() == 3
    nameless = spark.createDataFrame([(1, None, "ring", None), (2, "ring", None, None)], df.schema)
    assert search.relevance(nameless, query, F.col("name"), F.col("kw"), limit=1).count() == 1


@pytest.mark.parametrize(
    "query, best",
    [
        ("business name register", "BUSINESS_NAMES"),
        ("financial adviser", "FINANCIAL_ADVISERS"),
        ("liquidator", "LIQUIDATOR"),
        ("shorted shares", "SHORT_POSITIONS"),
        ("banned person", "BANNED_PERSONS"),
        ("smsf", "SMSF_AUDITORS"),
    ],
)
def test_catalogue_search_finds(spark, query, best):
    assert Engine(spark, Catalog(REGISTERS)).search(query, 1).head()["id"] == best


@given(st.one_of(st.none(), st.integers(), st.floats(), st.binary(), st.lists(st.text()), st.text(" \t\n")))
def test_bad_queries(bad):
    with pytest.raises(ValueError):
        search.check_query(bad)


@given(st.one_of(st.none(), st.floats(), st.text(), st.booleans(), st.integers(max_value=0), st.integers(min_value=search.MAX_HITS + 1)))
def test_bad_search_limits(limit):
    with pytest.raises(ValueError):
        topk.check_limit(limit, search.MAX_HITS)


def test_last_n_of_nothing_is_refused(sheet, spark):
    engine = Engine(spark, Catalog([SHEET])).bind("SHEET", sheet)
    for bad in (0, -3):
        with pytest.raises(ValueError):
            engine.query("SHEET", last_n=bad)


@pytest.mark.parametrize("word", ["NATOIN_7", "commonwelth bank", "x", "zzzz"])
def test_closest_values_against_difflib(spark, word):
    rng = random.Random(5)
    pool = [f"NATION_{i}" for i in range(25)] + ["commonwealth bank", "common wealth banks", "", "xy"]
    pool += ["".join(rng.choices("abNATIO_7", k=8)) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in pool + pool + [None]], "v string")
    for n, cutoff in ((3, 0.7), (1, 0.6), (10, 0.3)):
        got = [r["v"] for r in search.closest_values(df, "v", word, n, cutoff).collect()]
        assert got == difflib.get_close_matches(word, sorted(set(pool)), n, cutoff)


# -- snapshots -----------------------------------------------------------------


def test_resource_choice(spark):
    rows = [
        ("p", 0, "Data 2019", "CSV"), ("p", 1, "Data 2023-24", "csv "), ("p", 2, "Data 2023 old", "CSV"),
        ("p", 3, "Data 2030", "XLSX"), ("q", 0, "Data", "csv"), ("p", 4, None, "csv"),
    ]
    df = spark.createDataFrame(rows, "package string, n int, name string, format string")
    pick = snapshots.latest_resource(df, "package", "name", "n", pattern="^Data", fmt="csv")
    assert sorted((r["package"], r["n"], r["year"]) for r in pick.collect()) == [
        ("p", 1, 2023), ("q", 0, 0),
    ]
    exact = snapshots.latest_resource(df, "package", "name", "n", exact="Data 2019")
    assert [r["n"] for r in exact.collect()] == [0]
    with pytest.raises(ValueError):
        snapshots.latest_resource(df, "package", "name", "n")


def test_package_choice_anchors_at_the_start(spark):
    rows = [("o", 0, "stats-2021-22"), ("o", 1, "stats-2023-24"), ("o", 2, "old-stats-2030-31")]
    df = spark.createDataFrame(rows, "org string, n int, name string")
    pick = snapshots.latest_package(df, "org", "name", "n", r"stats-(\d{4})-\d{2}$").collect()
    assert [(r["n"], r["year"]) for r in pick] == [(1, 2023)]
    plain = snapshots.latest_package(df, "org", "name", "n", "stats-").collect()
    assert [(r["n"], r["year"]) for r in plain] == [(0, 0)]


@pytest.mark.parametrize(
    "url, allowed",
    [
        ("https://data.gov.au/x", True), ("http://DATA.gov.au/x", True),
        ("https://files.data.gov.au:443/x", True), ("https://data.gov.au.evil.com/", False),
        ("https://evildata.gov.au/", False), ("ftp://data.gov.au/x", False),
        ("https://evil.com/?u=data.gov.au", False), ("not a url", False), ("", False), (None, False),
    ],
)
def test_allowed_hosts(spark, url, allowed):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(snapshots.host_allowed(F.col("u"))).head()[0] is allowed


def test_resolving_an_address(spark):
    specs = spark.createDataFrame([("a", "da"), ("b", "db"), ("c", "dc"), ("d", "dd")], "id string, dflt string")
    dated = spark.createDataFrame([("a", "dated")], "id string, url string")
    listed = spark.createDataFrame(
        [("a", "http://data.gov.au/1"), ("b", "http://data.gov.au/2"), ("c", "http://evil.com/3")],
        "id string, url string",
    )
    got = snapshots.resolve(specs, dated, listed, "id", "url", "dflt").collect()
    assert {r["id"]: r["resolved"] for r in got} == {
        "a": "dated", "b": "http://data.gov.au/2", "c": "dc", "d": "dd",
    }


def test_dated_pick_bounds(spark):
    df = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-10', DATE '2024-02-01')) AS d")

    def pick(day, back):
        return str(snapshots.dated_pick(df, "d", F.lit(day).cast("date"), back).head()[0])

    assert pick("2024-01-11", 10) == "2024-01-10"
    assert pick("2024-01-20", 10) == "2024-01-10"
    assert pick("2024-01-21", 10) == "None"
    assert pick("2024-01-10", 0) == "2024-01-10"


def test_fresh_or_newest_stale_copy(spark):
    df = spark.sql("""
        SELECT * FROM VALUES ('k', 'data', TIMESTAMP '2024-01-01 00:00:00', 1),
            ('k', 'data', TIMESTAMP '2024-01-02 00:00:00', 2),
            ('old', 'latest', TIMESTAMP '2024-01-01 00:00:00', 3),
            ('odd', 'unknown', TIMESTAMP '2024-01-03 00:00:00', 4) AS t(key, kind, at, n)
    """)
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    got = snapshots.fallback_pick(df, ["key"], "kind", "at", now).collect()
    assert {r["key"]: (r["n"], r["stale"], r["age_minutes"]) for r in got} == {
        "k": (2, False, None), "old": (3, True, 2880), "odd": (4, True, 0),
    }


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, s string")
    same = snapshots.fingerprint(df.orderBy(F.col("i").desc()).repartition(3))
    one_less = snapshots.fingerprint(df.distinct())
    no_pair = snapshots.fingerprint(df.where("i = 1"))
    base = snapshots.fingerprint(df)
    assert not snapshots.changed(base, same).head()[0]
    assert snapshots.changed(base, one_less).head()[0]
    assert snapshots.changed(base, no_pair).head()[0]  # xor alone would not notice the lost pair
    assert snapshots.fingerprint(df.where("false")).head()["row_count"] == 0


def test_newest_per_key(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 9, 4)]
    df = spark.createDataFrame(rows, "k string, ts int, n int")
    got = snapshots.upsert(df.where("n < 3"), df.where("n >= 3"), ["k"], ["ts", "n"]).collect()
    assert sorted((r["k"], r["n"]) for r in got) == [("a", 3), ("b", 4)]


# -- audit and catalogue -------------------------------------------------------


def test_audit(things, raw):
    spec = dataclasses.replace(SPEC, enums={"state": {"nsw": "NSW", "qld": "QLD"}})
    got = {(r["code"], r["rows"], r["status"]) for r in audit.enum_audit(things, spec).collect()}
    assert got == {("NSW", 2, "ok"), ("VIC", 1, "undeclared"), ("QLD", 0, "unseen")}
    assert audit.missing_columns(raw, AFS_LICENSEE)[0] == "REGISTER_NAME"
    assert audit.duplicate_keys(things.unionByName(things.limit(1)), SPEC).count() == 1
    checks = {r["key"]: r["constant"] for r in audit.constant_columns(raw, ["Extra", "Code"]).collect()}
    assert checks == {"Extra": True, "Code": False}


def test_catalogue_frames(spark):
    engine = Engine(spark, Catalog(REGISTERS))
    assert [r["id"] for r in engine.tables().collect()] == engine.ids()
    details = engine.describe("short_positions").collect()
    assert [r["kind"] for r in details] == ["dimension"] * 2 + ["measure"] * 3
    assert details[2]["unit"] == "Shares"
    values = cat.enum_values(spark, [engine.catalog.get("COMPANIES")])
    assert values.where("key = 'status' AND alias = 'active'").head()["source_value"] == "REGD"


def test_long_text_is_cut_where_asked_for(spark):
    cells = {c.source: "x" for c in AFS_LICENSEE.columns} | {"AFS_LIC_CONDITION": "y" * 500}
    df = spark.createDataFrame([tuple(cells.values())], list(cells))
    engine = Engine(spark, Catalog(REGISTERS)).bind("AFS_LICENSEE", df)
    cut = engine.query("AFS_LICENSEE", cut_text=200).head()["dimensions"]["authorisation"]
    assert cut == "y" * 200 + TRUNCATION_SUFFIX
    full = engine.query("AFS_LICENSEE").head()["dimensions"]["authorisation"]
    assert full == "y" * 500
    # the filter sees the whole text
    assert engine.query("AFS_LICENSEE", {"authorisation": "y" * 300}).count() == 1


def test_most_shorted(spark):
    rows = [("Ore", "ORE", "10", "100", "10.0"), ("Gas", "GAS", "30", "100", "30.0"), ("Tin", "TIN", "", "1", "")]
    df = spark.createDataFrame(rows, [c.source for c in SHORT_POSITIONS.columns])
    table = project(df, SHORT_POSITIONS)
    top = topk.top_n(table, "short_percent", 2, ["product_code"]).collect()
    assert [r["product_code"] for r in top] == ["GAS", "ORE"]
    long = Engine(spark, Catalog(REGISTERS)).bind("SHORT_POSITIONS", df).query("SHORT_POSITIONS")
    assert long.count() == 7
