"""Trigram index: exact answers whatever the needle, and scans that leave files and pages out."""

import random

import pytest
from pyspark.sql import functions as F

from musterroll import Catalog, Engine, TableSpec
from musterroll.operators.project import project
from musterroll.sources import tables, text_index
from musterroll.specs import columns

SPEC = TableSpec(
    id="FIRMS",
    name="Firms",
    columns=columns("""
        code   id         string  Code
        name   id         string  Name
        state  dimension  string  State
        size   measure    double  Size
    """),
)
PARTS = ["bank", "Bánk", "Äpfel & Söhne", "pty", "LTD", "😀 smile", "a.b*c", "x\ny", "mine", "western"]


def rows(n=1200, seed=1):
    draw = random.Random(seed)
    names = [" ".join(draw.choices(PARTS, k=draw.randrange(1, 5))) + f" {i:05d}" for i in range(n)]
    names[5], names[6], names[7] = None, "", "ab"
    return [(f"c{i}", name, "NSW" if i % 3 else "VIC", str(i)) for i, name in enumerate(names)]


@pytest.fixture(scope="module")
def firms(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("index") / "firms")
    raw = spark.createDataFrame(rows(), "Code string, Name string, State string, Size string")
    tables.materialise(raw, target, spec=SPEC, cluster_by=["code"], text_index=["name", "state"], block_rows=8)
    return Engine(spark, Catalog([SPEC])).bind("FIRMS", target, materialised=True), target


def read(df):
    """Files and rows that the scan of a query takes in."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    number = lambda name: sum(s.metrics().apply(name).value() for s in scans if s.metrics().contains(name))
    return number("numFiles"), number("numOutputRows")


@pytest.mark.parametrize(
    "needle", ["bank", "BÁNK", "*00123*", "0012", "😀 sm", "söhne", "x\ny", "ab", "a.b*c", "zzz", "western 00", "bank pty ltd mine western 00"]
)
def test_answers_are_those_of_a_full_scan(spark, firms, needle):
    engine, target = firms
    plain = Engine(spark, Catalog([SPEC])).bind("FIRMS", spark.read.parquet(target), materialised=True)
    key = lambda e: sorted(map(tuple, e.rows("FIRMS", {"name": needle}).collect()), key=str)
    assert key(engine) == key(plain)
    mark = needle.replace("*", "").strip().lower()
    assert len(key(engine)) == sum(n is not None and mark in n.lower() for _, n, _, _ in rows())


def test_a_fraction_is_read(firms):
    engine, _ = firms
    files, found = read(engine.rows("FIRMS", {"name": "00123"}))
    assert files == 1 and found <= 64
    all_files, everything = read(engine.rows("FIRMS", {"name": "0"}))  # shorter than a run
    assert all_files >= 3 and everything > 1000
    assert read(engine.rows("FIRMS", {"name": "nowhere"}))[1] == 0
    both = engine.rows("FIRMS", {"name": "00123", "code": "c123"})
    assert [r["code"] for r in both.collect()] == ["c123"]


def test_other_filters_and_lists_do_not_use_it(firms):
    engine, _ = firms
    name = rows()[20][1]
    assert [r["code"] for r in engine.rows("FIRMS", {"name": [name]}).collect()] == ["c20"]
    assert engine.rows("FIRMS", {"state": "nsw", "name": "000"}).count() == engine.rows("FIRMS", {"name": "000"}).where("state = 'NSW'").count()
    with pytest.raises(ValueError, match="nothing left"):
        engine.rows("FIRMS", {"name": "**"})


def test_an_index_of_other_files_is_not_used(spark, tmp_path):
    target = str(tmp_path / "firms")
    first = spark.createDataFrame(rows(100), "Code string, Name string, State string, Size string")
    tables.materialise(first, target, spec=SPEC, text_index=["name"], block_rows=4)
    late = first.where("Code = 'c50'").withColumn("Name", F.lit("late arrival"))
    stored = [c for c in spark.read.parquet(target).columns if c != text_index.BLOCK]
    text_index.with_blocks(project(late, SPEC).select(*stored)).write.mode("append").parquet(target)
    engine = Engine(spark, Catalog([SPEC])).bind("FIRMS", target, materialised=True)
    assert [r["code"] for r in engine.rows("FIRMS", {"name": "late arr"}).collect()] == ["c50"]


def test_runs_and_ranges():
    assert text_index.runs_of("ab") == [] and text_index.runs_of("abcd") == ["abc", "bcd"]
    long = "".join(map(chr, range(200, 400)))
    assert len(text_index.runs_of(long)) <= text_index.MOST_RUNS and set(text_index.runs_of(long)) <= {long[i : i + 3] for i in range(198)}
    assert text_index.ranges([1, 2, 3, 7, 9, 10]) == [(1, 3), (7, 7), (9, 10)] and text_index.ranges([4]) == [(4, 4)]
    spread = [i * i for i in range(500)]
    closed = text_index.ranges(spread)
    assert len(closed) == text_index.MOST_RANGES and all(any(a <= b <= z for a, z in closed) for b in spread)
