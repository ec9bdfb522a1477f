"""Records of delimited text with line breaks inside quotes, from files that split.

Spark's text source splits a file anywhere and gives whole lines, but a line may lie inside a
quoted field.  Whether a split starts inside one follows from the number of quotes before it:
a first pass counts quotes per split, a running sum per file tells with which parity each
split starts.  That table has one row per split, some megabytes of text each, and goes to
every task.  The second pass reads the lines again, in order, and puts lines together to
records wherever the parity is odd between them.  A record that crosses the end of a split
leaves pieces, one or two per split, which are joined by file and order.

Records end with a line feed, with or without a carriage return before it, or with a lone
carriage return; line ends inside quotes stay as they are.  A quote that is never closed
runs to the end of the file.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from musterroll.functions.cleaning import strip_text

WHOLE, HEAD, MIDDLE, TAIL = range(4)


def lines_of(spark: SparkSession, paths: Sequence[str], single_byte: bool = False) -> DataFrame:
    """(path, block, value, quotes): lines in the order of their split."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1") if single_byte else F.make_valid_utf8("value")
    return lines.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        text.alias("value"),
        (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """Per split: does it start inside quotes, and is there no text in its file before it?"""
    splits = lines.groupBy("path", "block").agg(
        F.sum("quotes").alias("quotes"), F.bool_or(~strip_text("value").isin("", "\ufeff")).alias("text")
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        F.col("path").alias("in_path"),
        F.col("block").alias("in_block"),
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("opened"),
        (~F.coalesce(F.bool_or("text").over(before), F.lit(False))).alias("first"),
    )


def at_returns(record: str) -> list[str]:
    """A record cut at carriage returns outside quotes."""
    out, held, inside = [], "", False
    for piece in record.split("\r"):
        held = f"{held}\r{piece}" if inside else piece
        inside = inside != (piece.count('"') % 2 == 1)
        if not inside:
            out.append(held)
    return out + [held] if inside else out


def _spoken(record: str) -> bool:
    return bool(record.replace("\ufeff", "").strip())


class _Split:
    """Puts the lines of one split together, batch by batch."""

    def __init__(self, path: int, block: int, opened: bool, first: bool):
        self.key, self.inside, self.held, self.kind = (path, block), opened, [], HEAD if opened else WHOLE
        self.skip = first  # the first record with text is the header

    def _kept(self, records: list[str]) -> list[str]:
        out = []
        for record in records:
            for one in at_returns(record.removesuffix("\r")):
                if self.skip:  # nothing counts up to the header
                    self.skip = not _spoken(one)
                elif one:
                    out.append(one)
        return out

    def take(self, values: pa.Array, quotes: np.ndarray) -> tuple[list[tuple[int, str]], pa.Array | None]:
        """(kind, text) of records put together, and lines that are records as they are."""
        after = (int(self.inside) + np.cumsum(quotes)) % 2 == 1
        self.inside = bool(after[-1])
        ends = np.flatnonzero(~after)
        if not len(ends):
            self.held += values.to_pylist()
            return [], None
        starts = np.concatenate([[0], ends[:-1] + 1])
        joined = ends > starts
        joined[0] |= bool(self.held) or self.kind == HEAD
        made: list[tuple[int, str]] = []
        for s, e in zip(starts[joined], ends[joined], strict=True):
            text = "\n".join([*self.held, *values.slice(s, e - s + 1).to_pylist()])
            self.held = []
            made.append((self.kind, text))
            self.kind = WHOLE
        self.held = values.slice(int(ends[-1]) + 1).to_pylist()
        if self.skip:  # in order, until the header is found
            single = zip(ends[~joined].tolist(), values.take(pa.array(ends[~joined])).to_pylist(), strict=True)
            whole = sorted([*zip(ends[joined].tolist(), (t for _, t in made), strict=True), *single])
            return [(WHOLE, t) for t in self._kept([t for _, t in whole])], None
        made = [x for kind, t in made for x in ([(kind, t)] if kind == HEAD else [(WHOLE, r) for r in self._kept([t])])]
        plain = values.take(pa.array(ends[~joined]))
        if len(plain) and pc.any(pc.match_substring(plain, "\r")).as_py():
            return made + [(WHOLE, t) for t in self._kept(plain.to_pylist())], None
        return made, plain.filter(pc.greater(pc.binary_length(plain), 0))

    def close(self) -> list[tuple[int, str]]:
        if not self.held:
            return []
        kind = MIDDLE if self.kind == HEAD else TAIL
        return [(kind, "\n".join(self.held))]


_NAMES = ["path", "block", "kind", "record"]


def _batch(key: tuple[int, int], made: list[tuple[int, str]]) -> pa.RecordBatch:
    n = len(made)
    return pa.record_batch(
        [pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.int64()), pa.array([k for k, _ in made], pa.int32()), pa.array([t for _, t in made], pa.string())],
        names=_NAMES,
    )


def _stitch(batches):
    now: _Split | None = None
    for batch in batches:
        path, block = (batch.column(i).to_numpy() for i in (0, 1))
        quotes = batch.column(3).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *new], [*new, len(batch)], strict=True):
            if lo == hi:
                continue
            key = (int(path[lo]), int(block[lo]))
            if now is None or now.key != key:
                if now is not None and (left := now.close()):
                    yield _batch(now.key, left)
                now = _Split(*key, batch.column(4)[lo].as_py(), batch.column(5)[lo].as_py())
            made, plain = now.take(batch.column(2).slice(lo, hi - lo), quotes[lo:hi])
            if made:
                yield _batch(key, made)
            if plain is not None and len(plain):
                n = len(plain)
                yield pa.record_batch([pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(np.zeros(n, np.int32)), plain], names=_NAMES)
    if now is not None and (left := now.close()):
        yield _batch(now.key, left)


def _cut(batches):
    for batch in batches:
        found = [t for r in batch.column(0).to_pylist() for t in at_returns(r.removesuffix("\r")) if t]
        yield pa.record_batch([pa.array(found, pa.string())], names=["record"])


def records(spark: SparkSession, paths: Sequence[str], single_byte: bool = False) -> DataFrame:
    """(record): every record of the files but blank ones and each file's header.

    Headers must be on one line.
    """
    lines = lines_of(spark, paths, single_byte)
    # one row per split, so that lines stay in their order
    starts = F.broadcast(split_starts(lines))
    known = lines.join(starts, (F.col("path") == F.col("in_path")) & (F.col("block") == F.col("in_block")))
    pieces = known.select("path", "block", "value", "quotes", "opened", "first").mapInArrow(_stitch, "path long, block long, kind int, record string")
    order = Window.partitionBy("path").orderBy("block", "kind")
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = crossing.groupBy("path", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    whole = joined.select(text.alias("record")).mapInArrow(_cut, "record string")
    return pieces.where(F.col("kind") == WHOLE).select("record").unionByName(whole)


def parsed(found: DataFrame, width: int, delimiter: str) -> DataFrame:
    """Records as text columns ``c0``, ``c1``, ..."""
    kind = ", ".join(f"c{i} string" for i in range(width))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return found.select(F.from_csv("record", kind, options).alias("row")).select("row.*")
