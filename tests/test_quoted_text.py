"""Records across splits: every cut of a file gives the rows that a reader of whole files gives."""

import csv
import io
import random

import pytest

from musterroll.sources import delimited as D
from musterroll.sources import quoted_text as Q

FIELDS = ["", "x", "a,b", 'say ""no""', "two\nlines", "cr\r\nlf", "\n", " pad ", "é😀", '"', "three\n\nlong " * 5, "null", "\r"]


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def made_up(n, seed):
    draw = random.Random(seed)
    return [["id", "one", "two"], *([str(i), draw.choice(FIELDS), draw.choice(FIELDS)] for i in range(n))]


@pytest.fixture
def split_bytes(spark):
    """Splits of so many bytes for the length of a test."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in names}

    def set_to(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "0")

    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def got(df):
    return sorted(tuple(r) for r in df.select("id", "one", "two").fillna("").collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 160, 1000, 1 << 20])
def test_any_split_gives_the_same_rows(spark, tmp_path, split_bytes, size, end):
    want = []
    for k, n in enumerate([150, 60, 1]):
        rows = made_up(n, k)
        (tmp_path / f"f{k}.csv").write_bytes(("\n \n" if k else "﻿").encode() + text_of(rows, end).encode())
        want += map(tuple, rows[1:])
    split_bytes(size)
    df = D.read_delimited(spark, str(tmp_path), drop_null_tokens=False)
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()
    assert got(df) == sorted(want)


def test_one_field_over_many_splits(spark, tmp_path, split_bytes):
    rows = [["id", "one", "two"], ["1", "line\n" * 3000, "x"], ["2", "y", "\n\n"], ["3", "", "z" * 5000]]
    (tmp_path / "f.csv").write_text(text_of(rows), newline="")
    split_bytes(128)
    assert got(D.read_delimited(spark, str(tmp_path), drop_null_tokens=False)) == sorted(map(tuple, rows[1:]))


def test_same_as_the_reader_of_whole_files(spark, tmp_path, split_bytes):
    body = 'id,one,two\n1,a\n\n2,b,c,d\n  \n3,"a ""\n",y"z\n'  # short, blank, long rows; odd quotes
    (tmp_path / "f.csv").write_text(body)
    want = sorted(map(tuple, D.scan(spark, str(tmp_path)).fillna("").collect()))
    split_bytes(8)
    assert got(D.read_delimited(spark, str(tmp_path), drop_null_tokens=False)) == want


def test_a_quote_left_open_runs_to_the_end(spark, tmp_path, split_bytes):
    (tmp_path / "f.csv").write_text('id,one,two\n1,a,b\n3,"open, quoted\n4,x,y\n')
    split_bytes(8)
    assert got(D.read_delimited(spark, str(tmp_path))) == [("1", "a", "b"), ("3", "open, quoted\n4,x,y", "")]


def test_single_byte_files_and_lone_returns(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_bytes('id,one,two\n1,"café –\nline",€\n'.encode("cp1252"))
    (tmp_path / "b.csv").write_bytes(b'id,one,two\r2,"b\rc",d\r3,e,f\r')
    split_bytes(5)
    assert got(D.read_delimited(spark, str(tmp_path))) == [("1", "café –\nline", "€"), ("2", "b\rc", "d"), ("3", "e", "f")]


def test_a_header_with_a_line_break_is_read_whole(spark, tmp_path, split_bytes):
    (tmp_path / "f.csv").write_text('id,"one\nmore",two\n1,"a\nb",c\n')
    split_bytes(8)
    df = D.read_delimited(spark, str(tmp_path))
    assert df.columns == ["id", "one\nmore", "two"] and [tuple(r) for r in df.collect()] == [("1", "a\nb", "c")]


def test_at_returns():
    assert Q.at_returns('a\r"b\rc"\rd') == ["a", '"b\rc"', "d"]
    assert Q.at_returns('"open\rend') == ['"open\rend'] and Q.at_returns("") == [""]
