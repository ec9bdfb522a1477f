"""Line dedup by site-relative frequency.

A page's lines are what its block tags set apart, without inline tags and runs of blanks.
For every host, the pages that hold a line are divided by the host's pages; a line above
the boilerplate ratio is dropped from all pages of that host.  Hosts with few pages say
nothing about boilerplate and keep their lines.

Lines travel as 128-bit digests with their host; pages travel once, to meet the short list
of their own lines to drop.  Counting is by (host, line), so one host that holds most
pages is spread over all tasks, and a line on every page of it adds up inside each task
before anything is shuffled.

Edge cases: null or empty html has no lines; a url without a host belongs to the host
``""``; a null id is kept; a page given twice counts twice; a line that repeats inside a
page counts once for it; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.llm.shared import written

RATIO, LEAST_PAGES = 0.3, 5
#: Tags that end a line, and elements without text of their own.
BREAKS = r"(?is)</?(p|br|li|ul|ol|h[1-6]|div|nav|article|section|header|footer|aside|main|title|table|tr|td|th|pre|blockquote|html|head|body|form|figure|dl|dt|dd|hr)\b[^>]*>|[\r\n]+"
HIDDEN = r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>"


def host_of(url: Column) -> Column:
    """Lower-case host of a url, without user and port."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^\s*[a-z][a-z0-9+.-]*://([^/?#\s]*)", 1)
    return F.regexp_replace(F.regexp_replace(found, r"^.*@", ""), r":\d*$", "")


def lines_of(html: Column) -> Column:
    """Lines of a page: what block tags and line breaks set apart, with a character."""
    seen = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    cut = F.split(F.regexp_replace(seen, BREAKS, "\n"), "\n", -1)
    bare = F.transform(cut, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", ""), r"\s+", " ")))
    return F.filter(bare, lambda x: x != "")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def drop_site_lines(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """(id, host, n_lines, n_dropped, kept): pages without their host's boilerplate.

    ``kept`` is the page's remaining lines, joined by line breaks.
    """
    own = F.monotonically_increasing_id()
    rows = pages.select(F.col(id).alias("id"), host_of(F.col(url)).alias("host"), lines_of(F.col(html)).alias("lines"))
    rows = written(rows.withColumn("row", own), "pages")  # written, so that row numbers stay
    held = rows.select("row", "host", F.explode(F.array_distinct(F.transform("lines", _digest))).alias("line"))
    totals = rows.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    counts = held.groupBy("host", "line").agg(F.count("*").alias("n"))
    common = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages")).select("host", "line")
    drops = held.join(common, ["host", "line"]).groupBy("row").agg(F.collect_list("line").alias("drop"))
    found = rows.join(drops, "row", "left")
    none = F.expr("cast(array() as array<binary>)")
    kept = F.filter("lines", lambda x: ~F.array_contains(F.coalesce("drop", none), _digest(x)))
    cut = found.select("id", "host", F.size("lines").cast("bigint").alias("n_lines"), kept.alias("kept"))
    return cut.select(
        "id",
        "host",
        "n_lines",
        (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept"),
    )
