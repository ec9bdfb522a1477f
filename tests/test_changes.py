"""Keyed loads that rewrite few files and survive a crash; signatures of raw files."""

import hashlib
import os
import random
from pathlib import Path

from pyspark.sql import functions as F

from musterroll.sources import signatures
from musterroll.streaming import keyed
from musterroll.workload import files as file_queries

SCHEMA = "k string, at int, v string"


def files(target):
    return {str(p.relative_to(target)) for p in Path(target).rglob("*.parquet")}


def rows(spark, target):
    return sorted(tuple(r) for r in keyed.read_latest(spark, target).select("k", "at", "v").collect())


def newest(changes):
    out = {}
    for k, at, v in changes:
        if k not in out or (at, v) >= out[k]:
            out[k] = (at, v)
    return sorted((k, *x) for k, x in out.items())


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    target, stage = str(tmp_path / "t"), str(tmp_path / "s")
    draw = random.Random(4)
    first = [(f"k{i}", draw.randrange(9), "a") for i in range(300)] + [("k7", 99, "hot")] * 50
    touched = keyed.merge_changes(spark.createDataFrame(first, SCHEMA), target, f"{stage}/0", ["k"], ["at", "v"], 16)
    assert touched == list(range(16)) and rows(spark, target) == newest(first)
    before = files(target)
    second = [("k3", 50, "b"), ("k7", 1, "late"), ("new", 1, "c")]
    touched = keyed.merge_changes(spark.createDataFrame(second, SCHEMA), target, f"{stage}/1", ["k"], ["at", "v"], 16)
    assert 1 <= len(touched) <= 3 and rows(spark, target) == newest(first + second)
    kept = {f for f in before if int(f.split("/")[0].split("=")[1]) not in touched}
    assert kept <= files(target) and len(files(target) - before) == len(touched)
    empty = spark.createDataFrame([], SCHEMA)
    assert keyed.merge_changes(empty, target, f"{stage}/2", ["k"], ["at", "v"], 16) == []
    wider = spark.createDataFrame([("k3", 60, "d", "extra")], SCHEMA + ", w string")
    keyed.merge_changes(wider, target, f"{stage}/3", ["k"], ["at", "v"], 16)
    assert keyed.read_latest(spark, target).where("k = 'k3'").head()["v"] == "d"


def test_a_batch_begun_before_a_crash_is_repeated(spark, tmp_path):
    target, stage = str(tmp_path / "t"), str(tmp_path / "s")
    first, second = [("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y")]
    keyed.merge_changes(spark.createDataFrame(first, SCHEMA), target, f"{stage}/0", ["k"], ["at", "v"], 1)
    # the second batch was merged, and the run ended after the old bucket was taken away
    merged = spark.createDataFrame([("a", 2, "y", 0), ("b", 1, "x", 0)], SCHEMA + ", _bucket int")
    merged.write.partitionBy("_bucket").parquet(f"{stage}/1-begun")
    lost = spark.createDataFrame([], SCHEMA + ", _bucket int")
    lost.write.mode("overwrite").parquet(target)
    keyed.merge_changes(spark.createDataFrame(second, SCHEMA), target, f"{stage}/1", ["k"], ["at", "v"], 1)
    assert rows(spark, target) == [("a", 2, "y"), ("b", 1, "x")]


def test_stream_loads_every_change_once(spark, tmp_path):
    source, target, point = (str(tmp_path / n) for n in ("in", "t", "c"))
    changes = []
    for n in range(3):
        batch = [(f"k{i % 5}", 10 * n + i, f"v{n}") for i in range(8)]
        changes += batch
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        keyed.load_latest(stream, target, point, ["k"], ["at", "v"], 4).awaitTermination()
        assert rows(spark, target) == newest(changes)
    again = files(target)
    keyed.load_latest(stream, target, point, ["k"], ["at", "v"], 4).awaitTermination()
    assert files(target) == again


def test_signatures_of_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    texts = {"a b.csv": "h\n1\n2\n3\n", "c.csv": "h\n1\n1\n", "d.csv": "h\n", "e.csv": ""}
    for name, text in texts.items():
        (folder / name).write_text(text)
    first = signatures.file_signatures(spark, str(folder))
    first = spark.createDataFrame(first.collect(), first.schema)
    by = {r["path"].rsplit("/", 1)[-1]: r for r in first.collect()}
    assert {n: r["n_lines"] for n, r in by.items()} == {"a%20b.csv": 4, "c.csv": 3, "d.csv": 1}  # files without a byte are not listed
    # the same bytes in another order inside, a doubled pair, one that only gets a new time, one gone, one new
    (folder / "a b.csv").write_text("h\n2\n1\n3\n")
    (folder / "c.csv").write_text("h\n2\n2\n")
    os.utime(folder / "d.csv", (1, 1))
    (folder / "f.csv").write_text("x")
    second = signatures.file_signatures(spark, str(folder), known=first)
    got = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in signatures.file_changes(first, second).collect()}
    assert got == {"a%20b.csv": "same", "c.csv": "changed", "d.csv": "same", "f.csv": "new"}
    gone = signatures.file_changes(first, second.where(~F.col("path").endswith("c.csv"))).where("status = 'gone'").collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in gone] == ["c.csv"]


def test_files_with_old_metadata_are_not_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n")
    known = signatures.file_signatures(spark, str(tmp_path)).withColumn("digest", F.lit("from before"))
    known = spark.createDataFrame(known.collect(), known.schema)
    assert [r["digest"] for r in signatures.file_signatures(spark, str(tmp_path), known).collect()] == ["from before"]


def test_signatures_sort_no_lines(spark, tmp_path):
    texts = {f"{n}.csv": [f"{n}-{i}" * (i % 5) for i in range(300 * n)] + ["end"] for n in (1, 2)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many splits of each file, in any order
    try:
        found = signatures.content_signatures(spark, [str(tmp_path)])
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["path"].rsplit("/", 1)[-1]: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lowest = [x for x in plan.splitlines() if "Aggregate(" in x][-1]  # takes in the lines
    assert "HashAggregate(" in lowest and "ObjectHash" not in lowest
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    want = {name: (len(lines), md5(lines[0]), md5(lines[-1])) for name, lines in texts.items()}
    assert {name: (r["n_lines"], r["head"], r["tail"]) for name, r in got.items()} == want


def test_no_task_holds_all_parts_of_a_look(spark, sf_dir, monkeypatch):
    plans, write = [], file_queries.write_csv

    def seen(rows, *args, **more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *args, **more)

    monkeypatch.setattr(file_queries, "write_csv", seen)
    status = {r["part"]: r["status"] for r in file_queries.file_changes(spark, sf_dir).collect()}
    assert status == {"F": "gone", "O": "changed", "P": "same", "X": "new"}
    assert len(plans) == 2 and all("hashpartitioning(part" in p for p in plans)
