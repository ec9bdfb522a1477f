import pytest
from pyspark.sql import functions as F

from musterroll import REGISTERS, Catalog, Engine
from musterroll.operators.project import project
from musterroll.sources import delimited as D
from musterroll.sources import tables as S
from musterroll.sources.carve import carve, with_row_number
from musterroll.specs.loading import spec_from_mapping
from musterroll.specs.registers import BUSINESS_NAMES, COMPANIES, SHORT_POSITIONS
from musterroll.streaming.incremental import daily_files, load_new_files

BANNED = (
    "﻿REGISTER_NAME\tBD_ORG_ACN\tBD_ORG_NAME\tBD_ORG_TYPE\tBD_ORG_URL\tBD_ORG_START_DT"
    "\tBD_ORG_END_DT\tBD_ORG_COMMENT\n"
    "Banned\t081402379\t ABC PTY \tCredit Banning\tNULL\t07/11/2006\tPermanent banning\tnull\n"
    'Banned\t000000017\t"SAID ""NO""\nTWICE"\tCredit banning\t\t1/2/2007\t\tx, y\n'
)


def collect(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "content, delimiter, header",
    [
        ("\n  \na\tb\tc,d\n1,2,3,4,5", "\t", "a\tb\tc,d"),
        ("a,b\tc\n", ",", "a,b\tc"),
        ("\ufeffa,b,c", ",", "a,b,c"),
        ("\n" * 9000 + "a\tb\n1\t2\n", "\t", "a\tb"),
        ("x" * 9000 + "\ty\n1\t2\n", "\t", "x" * 9000 + "\ty"),
    ],
)
def test_heads_of_files(spark, tmp_path, content, delimiter, header):
    (tmp_path / "f.txt").write_text(content, encoding="utf-8")
    got = D.file_heads(spark, str(tmp_path)).collect()
    assert [(r["delimiter"], r["header"]) for r in got] == [(delimiter, header)]


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "full.txt").write_text("a\tb\n1\t2\n")
    groups = D.file_groups(spark, str(tmp_path))
    assert [(g.delimiter, g.header, len(g.paths)) for g in groups] == [("\t", "a\tb", 1)]


def test_headers():
    assert D.normalize_header("﻿ Name \n of  entity ") == "Name\nof  entity"


def test_tab_file_with_bom_quotes_and_line_breaks(spark, tmp_path):
    folder = tmp_path / "with space %41"
    folder.mkdir()
    (folder / "orgs.csv").write_text(BANNED, encoding="utf-8")
    df = D.read_delimited(spark, str(folder))
    assert df.columns[0] == "REGISTER_NAME" and len(df.columns) == 8
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    rows = {r["BD_ORG_ACN"]: r for r in df.collect()}
    assert set(rows) == {"081402379", "000000017"}  # zeros kept
    assert rows["000000017"]["BD_ORG_NAME"] == 'SAID "NO"\nTWICE'
    assert rows["081402379"]["BD_ORG_URL"] is None and rows["081402379"]["BD_ORG_COMMENT"] is None

    clean = project(df, Catalog(REGISTERS).get("BANNED_ORGS")).collect()
    by_acn = {r["acn"]: r for r in clean}
    assert by_acn["081402379"]["org_name"] == "ABC PTY"
    assert by_acn["081402379"]["start_date"] == "2006-11-07"
    assert by_acn["081402379"]["end_date"] == "Permanent banning"
    assert by_acn["000000017"]["start_date"] == "2007-02-01"


def test_encodings_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("ID,NOTE\n1,café “x” €\n".encode("cp1252"))
    (tmp_path / "b.csv").write_bytes("ID,NOTE\n2,café 日\n".encode())
    (tmp_path / "c.csv").write_bytes(b"ID,NOTE\n3,odd \x81 byte\n")
    (tmp_path / "d.csv").write_bytes(b"ID,NOTE\n4,plain\n")
    found = {r["path"][-5:]: r["encoding"] for r in D.file_heads(spark, str(tmp_path)).collect()}
    assert found == {
        "a.csv": "windows-1252", "b.csv": "utf-8", "c.csv": "iso-8859-1", "d.csv": "utf-8",
    }
    got = dict(collect(D.read_delimited(spark, str(tmp_path)).select("ID", "NOTE")))
    assert got == {
        "1": "café “x” €", "2": "café 日", "3": "odd \x81 byte", "4": "plain",
    }


def test_files_that_differ_in_delimiter_and_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("\n\nB\tA\tC\n4\t3\t5\n")
    groups = D.file_groups(spark, str(tmp_path))
    assert sorted((g.delimiter, g.header) for g in groups) == [("\t", "B\tA\tC"), (",", "A,B")]
    got = D.read_delimited(spark, str(tmp_path)).select("A", "B", "C")
    assert sorted(collect(got)) == [("1", "2", None), ("3", "4", "5")]
    with pytest.raises(ValueError, match="encoding must be"):
        D.scan(spark, str(tmp_path), encoding="utf-7")


def test_carving_a_sub_table(spark, tmp_path):
    lines = ["Title,,", ",,", " Metric ,Unit,2024", ",,", "a,AUD,1", "b,AUD,2", "c,AUD,3", "Note: x,,"]
    (tmp_path / "sheet.csv").write_text("\n".join(lines) + "\n")
    raw = D.scan(spark, str(tmp_path), header=False, multiline=False)
    grid = with_row_number(raw.na.fill(""))
    sheet = carve(grid, header_row=3, data_start_row=5, max_rows=3)
    assert sheet.columns == ["Metric", "Unit", "2024"]
    assert sorted(collect(sheet)) == [("a", "AUD", "1"), ("b", "AUD", "2"), ("c", "AUD", "3")]
    assert carve(grid, 3).count() == 5
    for bad in (dict(header_row=0), dict(header_row=3, data_start_row=3), dict(header_row=99)):
        with pytest.raises(ValueError):
            carve(grid, **bad)


def test_row_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("".join(f"{i:07d}\n" for i in range(1, 50_001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        raw = D.scan(spark, str(path), header=False, multiline=False)
        assert raw.rdd.getNumPartitions() > 8
        numbered = with_row_number(raw)
        assert numbered.where(F.col("_c0").cast("int") != F.col("_row")).count() == 0
        assert numbered.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_materialise(spark, tmp_path):
    raw = spark.createDataFrame([("A", "1"), ("B", "2")], "x string, y string")
    target = str(tmp_path / "t")
    assert S.materialise(raw, target, columns=["y"]) == 2
    assert S.read_table(spark, target).columns == ["y"]
    with pytest.raises(ValueError, match="no rows"):
        S.materialise(raw.where("x = 'Z'"), target)
    assert S.read_table(spark, target).count() == 2  # the earlier table is untouched


def test_header_only_file_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Company Name,ACN,Status\n")
    with pytest.raises(ValueError, match="no rows"):
        S.materialise(D.read_delimited(spark, str(tmp_path / "c.csv")), str(tmp_path / "out"))


def test_missing_columns_are_named(spark):
    raw = spark.createDataFrame([("1",)], "ACN string")
    with pytest.raises(ValueError, match="Company Name.*\\.\\.\\."):
        project(raw, COMPANIES)


def test_materialise_many_isolates_failures(spark, tmp_path):
    def source(spec):
        if spec.id == "COMPANIES":
            raise OSError("gone")
        names = [c.source for c in spec.columns]
        return spark.createDataFrame([tuple("1" for _ in names)], names)

    out = S.materialise_many(
        spark, Catalog(REGISTERS), source, lambda s: str(tmp_path / s.id),
        ids=["COMPANIES", "BANNED_ORGS"],
    )
    got = {r["id"]: (r["status"], r["rows"]) for r in out.collect()}
    assert got["BANNED_ORGS"] == ("ok", 1)
    assert got["COMPANIES"][0].startswith("error: OSError") and got["COMPANIES"][1] is None
    with pytest.raises(ValueError, match="unknown table ids: NOPE"):
        S.materialise_many(spark, Catalog(REGISTERS), source, str, ids=["NOPE"])


@pytest.mark.parametrize("rows, kept", [(1, 1), (10, 10), (11, 11), (35, 35), (40, 40), (99, 40)])
def test_first_rows_reads_files_in_order(spark, tmp_path, rows, kept):
    target = str(tmp_path / "many files")
    spark.range(40).repartition(5).sortWithinPartitions("id").write.parquet(target)
    some = S.first_rows(spark, target, rows)
    assert some.count() == kept
    per_file = some.groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(per_file) <= 5


def test_scratch_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert S.shared_dir(spark) == base
    assert S.scratch_path(spark, "x").startswith(base)
    assert S.scratch_path(spark, "x") != S.scratch_path(spark, "x")


SHORT_HEADER = ",".join(c.source for c in SHORT_POSITIONS.columns)


def write_day(folder, day, *lines):
    folder.mkdir(exist_ok=True)
    text = "\n".join([SHORT_HEADER, *lines]) + "\n"
    (folder / f"RR{day}-001-SSDailyAggShortPos.csv").write_text(text)


def test_daily_files(spark, tmp_path):
    folder = tmp_path / "days"
    write_day(folder, "20240102", "Ore Ltd,ORE,10,100,10.0")
    write_day(folder, "20240103", "Ore Ltd,ORE,20,100,20.0", "Gas Ltd,GAS,x,100,")
    rows = D.read_dated_files(spark, str(folder), start="2024-01-03", end="2024-01-31")
    typed = project(rows, SHORT_POSITIONS, keep=["file_date"])
    got = sorted(tuple(map(str, r)) for r in typed.collect())
    assert got == [
        ("Gas Ltd", "GAS", "None", "100", "None", "2024-01-03"),
        ("Ore Ltd", "ORE", "20", "100", "20.0", "2024-01-03"),
    ]
    with pytest.raises(ValueError, match="no dated files"):
        D.read_dated_files(spark, str(folder), start="2030-01-01")


def test_stream_loads_each_file_once(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "days", str(tmp_path / "t"), str(tmp_path / "c")
    write_day(folder, "20240102", "Ore Ltd,ORE,10,100,10.0")

    def load():
        stream = daily_files(spark, str(folder), SHORT_POSITIONS)
        load_new_files(stream, target, checkpoint).awaitTermination()
        return spark.read.parquet(target).count()

    assert load() == 1
    assert load() == 1
    write_day(folder, "20240103", "Ore Ltd,ORE,20,100,20.0", "Gas Ltd,GAS,1,100,1")
    assert load() == 3
    days = spark.read.parquet(target).select("file_date").distinct().count()
    assert days == 2


COMPANY_ROWS = [
    ("ACME BANK PTY LTD", "007457141", "APTY", "REGD", "01/02/1990"),
    ("ACME MINING LTD", "000000012", "APUB", "DRGD", "15/06/1996"),
    ("BANKSIA LTD", "000000013", "RFCD", "REGD ", "30/06/1997"),
    ("Big (Blank) BANK", "000000014", "APTY", "REGD", ""),
]


@pytest.fixture()
def companies(spark, tmp_path):
    header = [c.source for c in COMPANIES.columns]
    at = {c.source: i for i, c in enumerate(COMPANIES.columns)}
    lines = [",".join(header)]
    for name, acn, kind, status, day in COMPANY_ROWS:
        cells = [""] * len(header)
        for source, value in zip(
            ("Company Name", "ACN", "Type", "Status", "Date of Registration"),
            (name, acn, kind, status, day),
        ):
            cells[at[source]] = value
        lines.append(",".join(cells))
    (tmp_path / "companies.csv").write_text("\n".join(lines) + "\n")
    engine = Engine(spark, Catalog(REGISTERS))
    assert engine.ingest("companies", str(tmp_path / "companies.csv"), str(tmp_path / "out")) == 4
    return engine


def names(df):
    return sorted(r["dimensions"]["company_name"] for r in df.collect())


def test_ingested_register_end_to_end(companies):
    assert names(companies.query("COMPANIES", {"company_name": "acme"})) == [
        "ACME BANK PTY LTD", "ACME MINING LTD",
    ]
    for form in ("bank", "BANK*", "*bank*", "bank~"):
        assert len(names(companies.query("COMPANIES", {"company_name": form}))) == 3
    # padded values are cleaned before they are filtered
    active = names(companies.query("COMPANIES", {"status": "active"}))
    assert active == ["ACME BANK PTY LTD", "BANKSIA LTD", "Big (Blank) BANK"]
    assert active == names(companies.query("COMPANIES", {"status": "REGD"}))
    assert names(companies.query("COMPANIES", {"acn": "007457141"})) == ["ACME BANK PTY LTD"]
    assert names(companies.query("COMPANIES", {"company_name": "(blank)"})) == ["Big (Blank) BANK"]
    assert companies.query("COMPANIES", {"company_name": "'; DROP TABLE x;--"}).count() == 0
    both = {"type": ["pty", "APUB"], "status": "active"}
    assert names(companies.query("COMPANIES", both)) == ["ACME BANK PTY LTD", "Big (Blank) BANK"]


def test_ingested_register_dates_and_output(companies):
    ranged = companies.query(
        "COMPANIES", start_period=1996, end_period="1997-06", date_column="registration_date"
    )
    assert names(ranged) == ["ACME MINING LTD", "BANKSIA LTD"]
    with pytest.raises(ValueError, match="date column"):
        companies.query("COMPANIES", start_period="1996")
    row = companies.query("COMPANIES", {"acn": "12"}).collect()
    assert len(row) == 1 and row[0]["period"] is None and row[0]["value"] is None
    assert row[0]["dimensions"]["registration_date"] == "1996-06-15"
    assert "abn" not in row[0]["dimensions"]
    flat = companies.query("COMPANIES", {"acn": "12"}, format="CSV")
    assert flat.columns == ["period", "measure", "value", "unit", *COMPANIES.dimension_keys]
    page = companies.latest("COMPANIES", limit=2).collect()
    assert [r["dimensions"]["company_name"] for r in page] == ["ACME BANK PTY LTD", "ACME MINING LTD"]
    assert {r["truncated_at"] for r in page} == {4}
    assert {r["truncated_at"] for r in companies.latest("COMPANIES").collect()} == {None}


def test_unfiltered_large_table_is_whole(spark, tmp_path):
    cells = [c.source for c in BUSINESS_NAMES.columns]
    raw = spark.range(150_000).select(*[F.col("id").cast("string").alias(c) for c in cells])
    engine = Engine(spark, Catalog(REGISTERS))
    raw.write.parquet(str(tmp_path / "bn"))
    for source in (raw, str(tmp_path / "bn")):
        engine.bind("BUSINESS_NAMES", source)
        assert engine.query("BUSINESS_NAMES").count() == 150_000
        assert engine.summary("BUSINESS_NAMES").head()["row_count"] == 150_000
    assert engine.latest("BUSINESS_NAMES", limit=1).head()["truncated_at"] == 150_000
    assert engine.query("BUSINESS_NAMES", {"business_name": "14999"}).count() == 12


def test_carved_register_and_clustered_files(spark, tmp_path):
    spec = spec_from_mapping({
        "id": "SHEETS", "name": "Sheets", "header_row": 3, "data_start_row": 5, "max_rows": 2,
        "columns": {
            "code": {"source_column": "Code", "role": "id"},
            "amount": {"source_column": "Amount", "dtype": "int"},
        },
    })
    lines = ["Some title\t", "\t", " Code \tAmount", "-\t-", "a\t1", "b\t2", "Source: x\t"]
    (tmp_path / "sheet.txt").write_text("\n".join(lines) + "\n")
    engine = Engine(spark, Catalog([spec]))
    target = str(tmp_path / "out")
    # blank cells of the grid are null, and only the rows of the sub-table remain
    assert engine.ingest("SHEETS", str(tmp_path / "sheet.txt"), target, cluster_by=["code"]) == 2
    assert sorted(collect(spark.read.parquet(target))) == [("a", 1), ("b", 2)]


def test_clustered_files_skip_row_groups(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(0, 4000, numPartitions=4).select(
        F.format_string("%09d", (F.col("id") * 7919) % 4000).alias("acn"), F.lit("x").alias("n")
    )
    hot = spark.range(0, 3000, numPartitions=8).select(F.lit("000000042").alias("acn"), F.lit("copy").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert S.materialise(rows.unionByName(hot), target, cluster_by=["acn"]) == 7000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(target).select(F.col("_metadata.file_path").alias("f"), "acn")
    holding = files.where("acn = '000003000'").select("f").distinct().count()
    spread = files.where("acn = '000000042'").select("f").distinct().count()
    assert holding == 1 and spread > 1


def test_suggestions(companies):
    near = companies.suggest("COMPANIES", "company_name", "ACME BANK PTY LDT").collect()
    assert near[0]["company_name"] == "ACME BANK PTY LTD"
    hint = companies.suggest("COMPANIES", "current_name", "2020").head()
    assert hint["requested"] == 2020 and hint["direction"] is None
    with pytest.raises(ValueError, match="cannot be filtered"):
        companies.suggest("COMPANIES", "nope", "x")


def test_summary_echoes_the_query(companies):
    row = companies.summary("COMPANIES", filters='{"status": "active"}').head()
    assert row["row_count"] == 3 and row["query"] == '{"filters": {"status": "active"}}'


@pytest.mark.parametrize("multiline", [True, False])
def test_byte_order_mark_and_pruned_columns(spark, tmp_path, multiline):
    for name, row in (("a", "1,2,3"), ("b", "4,5,6")):
        (tmp_path / f"{name}.csv").write_text(f"﻿A,B,C\n{row}\n", encoding="utf-8")
    df = D.read_delimited(spark, str(tmp_path), multiline=multiline)
    assert df.columns == ["A", "B", "C"]
    assert sorted(collect(df)) == [("1", "2", "3"), ("4", "5", "6")]
    assert sorted(collect(df.select("C", "A"))) == [("3", "1"), ("6", "4")]
    assert df.count() == 2


@pytest.mark.parametrize("multiline", [True, False])
def test_a_file_with_another_header_is_never_read_by_position(spark, tmp_path, multiline):
    (tmp_path / "d20240101.csv").write_text("A,B\n1,2\n")
    (tmp_path / "d20240102.csv").write_text("B,A\n4,3\n")
    rows = D.read_dated_files(spark, str(tmp_path), multiline=multiline)
    with pytest.raises(Exception, match="(?i)header"):
        rows.collect()
    grouped = D.read_delimited(spark, str(tmp_path), multiline=multiline).select("A", "B")
    assert sorted(collect(grouped)) == [("1", "2"), ("3", "4")]


def test_refresh_finds_converts_and_binds_the_newest_files(spark, tmp_path):
    header = "\t".join(c.source for c in BUSINESS_NAMES.columns)
    short = Catalog(REGISTERS).get("SHORT_POSITIONS")
    for name, rows in (("old", 1), ("new", 2)):
        lines = ["\t".join(f"{name}{i}" for _ in BUSINESS_NAMES.columns) for i in range(rows)]
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    for day in ("20240105", "20240109", "20240301"):
        cells = ",".join(["Ore", "ORE", day[-2:], "100", "10.0"])
        (tmp_path / f"RR{day}-001-SSDailyAggShortPos.csv").write_text(",".join(c.source for c in short.columns) + f"\n{cells}\n")
    resource = BUSINESS_NAMES.discovery["resource_name"]
    listing = [
        ("pub-business-names", resource, "CSV", f"file://{tmp_path}/new.csv", 1),
        ("pub-business-names", "Another file", "CSV", f"file://{tmp_path}/old.csv", 0),
        *[("daily", "x", "CSV", f"file://{tmp_path}/RR{d}-001-SSDailyAggShortPos.csv", 2) for d in ("20240105", "20240109", "20240301")],
    ]
    offered = spark.createDataFrame(listing, "package string, name string, format string, url string, ordinal int")
    engine = Engine(spark, Catalog(REGISTERS, prefixes=["pub"]))
    done = engine.refresh(
        offered, "2024-01-10", lambda spec: str(tmp_path / f"clean-{spec.id}"),
        ["BUSINESS_NAMES", "SHORT_POSITIONS", "COMPANIES"],
    ).collect()
    assert [(r["id"], r["status"][:5], r["rows"]) for r in done] == [
        ("BUSINESS_NAMES", "ok", 2), ("SHORT_POSITIONS", "ok", 1), ("COMPANIES", "error", None),
    ]
    assert done[1]["url"].endswith("RR20240109-001-SSDailyAggShortPos.csv")
    row = engine.summary("BUSINESS_NAMES", as_of="2024-03-01").head()
    assert (row["row_count"], row["stale"], row["source"]) == (2, True, f"file://{tmp_path}/new.csv")
    assert engine.summary("BUSINESS_NAMES", as_of="2024-01-12").head()["stale"] is False
    assert engine.values("COMPANIES").where("key = 'status'").count() == 5


def test_refresh_by_default_address_patterns_and_signatures(spark, tmp_path):
    spec = spec_from_mapping({
        "id": "FEES", "name": "Fees", "download_url": f"file://{tmp_path}/old.csv",
        "discovery": {"package_id_pattern": r"fees-(\d{4})", "resource_name_pattern": "^Fee table", "resource_format": "TXT"},
        "columns": {"code": {"source_column": "Code", "role": "id"}, "fee": {"source_column": "Fee", "role": "measure"}},
    })
    for name, rows in (("old", 1), ("y2023", 2), ("y2024", 3)):
        (tmp_path / f"{name}.csv").write_text("Code,Fee\n" + "".join(f"{name}{i},{i}\n" for i in range(rows)))
    columns = "package string, name string, format string, url string, ordinal int"
    listing = [(f"fees-{y}", f"Fee table {y}", "txt", f"file://{tmp_path}/y{y}.csv", i) for i, y in enumerate((2024, 2023))]
    listing.append(("fees-2024", "Notes", "txt", f"file://{tmp_path}/old.csv", 2))
    broken = spec_from_mapping({"id": "BROKEN", "name": "Broken", "discovery": {"package": "x", "resource_name": "a", "resource_name_pattern": "("},
                                "columns": {"code": {"source_column": "Code", "role": "id"}}})
    engine = Engine(spark, Catalog([broken, spec]))

    def run(offered):
        done = engine.refresh(
            spark.createDataFrame(offered, columns), "2024-02-01", lambda s: str(tmp_path / f"clean-{s.id}"), ["BROKEN", "FEES"],
            signatures=lambda s: str(tmp_path / f"signature-{s.id}"),
        )
        return {r["id"]: (r["status"][:9], (r["url"] or "").rsplit("/", 1)[-1], r["rows"]) for r in done.collect()}

    assert run(listing)["FEES"] == ("ok", "y2024.csv", 3)
    assert run(listing)["FEES"] == ("unchanged", "y2024.csv", None)
    assert engine.rows("FEES").count() == 3
    (tmp_path / "y2024.csv").write_text("Code,Fee\nz,9\n")
    assert run(listing)["FEES"] == ("ok", "y2024.csv", 1)
    assert run([])["FEES"] == ("ok", "old.csv", 1) and run([])["BROKEN"][0] == "error: no"
    with pytest.raises(ValueError):
        engine.query("FEES", format="csv", last_n=0)


def test_materialise_all_binds_what_it_wrote(spark, tmp_path):
    cells = [c.source for c in BUSINESS_NAMES.columns]
    raw = spark.range(30).select(*[F.col("id").cast("string").alias(c) for c in cells])

    def load(spec):
        if spec.id != "BUSINESS_NAMES":
            raise ValueError("x" * 500)
        return raw

    engine = Engine(spark, Catalog(REGISTERS))
    status = engine.materialise_all(load, lambda spec: str(tmp_path / spec.id), ["BUSINESS_NAMES", "COMPANIES"]).collect()
    assert status[0]["rows"] == 30 and len(status[1]["status"]) > 500
    assert engine.query("BUSINESS_NAMES").count() == 30
