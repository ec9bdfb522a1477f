"""Delimited text (CSV / TSV) to an all-text table, for files that differ in
delimiter, encoding or header.

Every column is read as text, so leading zeros of keys survive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.functions.cleaning import null_tokens, strip_text
from musterroll.operators.project import quoted
from musterroll.sources import quoted_text

# Date digits in the last part of a path.
DATE_IN_NAME = r"(\d{8})[^/]*$"

# The encodings tried in order, and how the bytes 0x80-0x9F read in
# windows-1252 (five of them are undefined).
ENCODINGS = ("utf-8", "windows-1252", "iso-8859-1")
UNDEFINED_1252 = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
SCAN_CHARSET = {"utf-8": "UTF-8", "windows-1252": "ISO-8859-1", "iso-8859-1": "ISO-8859-1"}


def normalize_header(name: str) -> str:
    """Strip every line of a header; a byte-order mark is not part of a name."""
    return "\n".join(part.strip() for part in name.lstrip("\ufeff").split("\n"))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Addresses of the files under paths; file contents are not read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("_metadata.file_path").alias("path"))


def delimiter_of(header: Column) -> Column:
    """Tab if the header line has more tabs than commas, else comma."""
    many = lambda mark: F.length(header) - F.length(F.replace(header, F.lit(mark), F.lit("")))
    return F.when(many("\t") > many(","), "\t").otherwise(",")


def file_heads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header line, delimiter and encoding of every file that has a byte.

    One splittable pass over the raw lines by Spark's own reader, reduced per file inside
    each task.  The header is the first line with any text, however far down it is; the
    encoding is the first of :data:`ENCODINGS` that reads the whole file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    undefined = "[" + "".join(f"\\x{b:02X}" for b in UNDEFINED_1252) + "]"
    raw = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    valid = F.is_valid_utf8("value")
    ascii_only = valid & (F.octet_length("value") == F.length("value"))
    line = F.regexp_replace(F.make_valid_utf8("value"), "^\ufeff", "")
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.when(strip_text(line) != "", place).alias("place"),
        line.alias("line"),
        valid.alias("utf8"),
        F.when(ascii_only, False).otherwise(raw.rlike(undefined)).alias("undefined"),
    )
    found = lines.groupBy("path").agg(
        F.min_by("line", "place").alias("header"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("undefined").alias("undefined"),
    )
    encoding = F.when(F.col("utf8"), ENCODINGS[0]).when(~F.col("undefined"), ENCODINGS[1])
    header = F.coalesce("header", F.lit(""))
    return found.select(
        "path",
        header.alias("header"),
        delimiter_of(header).alias("delimiter"),
        encoding.otherwise(ENCODINGS[2]).alias("encoding"),
    )


def from_1252(col: Column) -> Column:
    """Text read byte by byte as ISO-8859-1, corrected to windows-1252."""
    defined = [b for b in range(0x80, 0xA0) if b not in UNDEFINED_1252]
    return F.translate(
        col, "".join(map(chr, defined)), bytes(defined).decode("cp1252")
    )


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    multiline: bool = True,
    header: bool = True,
) -> DataFrame:
    """One group of files with the same delimiter, encoding and header, all text.

    ``multiline`` allows line breaks inside quotes but makes each file one task;
    without it large files split.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    df = (
        spark.read.option("header", header)
        .option("sep", delimiter)
        .option("encoding", SCAN_CHARSET[encoding])
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", False)
        # a file whose header differs is an error, never read by position
        .option("enforceSchema", False)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    names = [normalize_header(n) for n in df.columns]
    df = df.toDF(*names)
    if encoding == "windows-1252":
        df = df.select(*[from_1252(quoted(n)).alias(n) for n in names])
    return df


def scan_splits(spark: SparkSession, group: FileGroup) -> DataFrame:
    """Like :func:`scan` with ``multiline``, but large files split.

    Records are put together from Spark's lines by quote parity; the header must be on
    one line.
    """
    names = scan(spark, group.paths[:1], group.delimiter, group.encoding).columns  # reads a header
    found = quoted_text.records(spark, group.paths, single_byte=group.encoding != "utf-8")
    df = quoted_text.parsed(found, len(names), group.delimiter)
    fix = from_1252 if group.encoding == "windows-1252" else (lambda c: c)
    return df.select(*[fix(F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])


@dataclass(frozen=True)
class FileGroup:
    """Files that one scan can read."""

    delimiter: str
    encoding: str
    header: str
    paths: tuple[str, ...]


def file_groups(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str | None = None,
    encoding: str = "auto",
) -> list[FileGroup]:
    """Files by delimiter, encoding and header: metadata, one row per file.

    Files without a byte hold nothing and are left out.
    """
    known = F.col("encoding") if encoding == "auto" else F.lit(encoding).alias("encoding")
    rows = file_heads(spark, paths).select("path", "delimiter", "header", known).collect()
    groups: dict[tuple[str, str, str], list[str]] = {}
    for row in sorted(rows, key=lambda r: r["path"]):
        key = (delimiter or row["delimiter"], row["encoding"], row["header"])
        groups.setdefault(key, []).append(unquote(row["path"]))
    return [FileGroup(*key, tuple(files)) for key, files in groups.items()]


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str | None = None,
    encoding: str = "auto",
    multiline: bool = True,
    drop_null_tokens: bool = True,
) -> DataFrame:
    """CSV / TSV files of one register as one all-text table.

    Delimiter, header and, with ``encoding="auto"``, encoding are found per file, in one
    pass over the raw text.  Columns that a file lacks are null.  Files split, with
    ``multiline`` too, unless a header itself has a line break.
    """
    groups = file_groups(spark, paths, delimiter, encoding)
    if not groups:
        raise ValueError(f"no files under {paths!r}")
    parts = [
        scan_splits(spark, g) if multiline and g.header.count('"') % 2 == 0
        else scan(spark, g.paths, g.delimiter, g.encoding, multiline)
        for g in groups
    ]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not drop_null_tokens:
        return table
    return table.select(*[null_tokens(quoted(n)).alias(n) for n in table.columns])


def read_grid(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str | None = None,
    encoding: str = "auto",
    multiline: bool = True,
) -> DataFrame:
    """A sheet-like file as a grid of text cells without a header."""
    groups = file_groups(spark, path, delimiter, encoding)
    if len(groups) != 1 or len(groups[0].paths) != 1:
        raise ValueError("a grid is read from exactly one file")
    one = groups[0]
    return scan(spark, one.paths, one.delimiter, one.encoding, multiline, header=False)


def date_from_path(path: Column, pattern: str = DATE_IN_NAME, fmt: str = "yyyyMMdd") -> Column:
    """Date written in a file's name, or elsewhere in its path by another pattern."""
    return F.try_to_date(F.regexp_extract(path, pattern, 1), fmt)


def read_dated_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    multiline: bool = False,
    pattern: str = DATE_IN_NAME,
    fmt: str = "yyyyMMdd",
    column: str = "file_date",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Daily files with one header as one table, with the date of each file.

    A date range drops whole files before anything is read.
    """
    day = date_from_path(F.col("path"), pattern, fmt)
    keep = list_files(spark, paths).where(day.isNotNull())
    if start is not None:
        keep = keep.where(day >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep.where(day <= F.lit(end).cast("date"))
    files = sorted(unquote(r["path"]) for r in keep.collect())
    if not files:
        raise ValueError(f"no dated files under {paths!r}")
    table = scan(spark, files, delimiter, encoding, multiline)
    return table.withColumn(column, date_from_path(F.col("_metadata.file_path"), pattern, fmt))
