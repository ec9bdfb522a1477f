"""Choosing among snapshots, files and packages, with table operators."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hours a payload stays fresh per kind, days a converted table
# stays fresh, days after which a snapshot of a given cadence counts as stale,
# and the host (with its subdomains) that files may come from.
TTL_HOURS = {"data": 24, "latest": 6, "register": 24, "catalog": 1}
TABLE_TTL_DAYS = 14
CADENCE_DAYS = {"weekly": 14, "monthly": 45}
PORTAL_HOST = "data.gov.au"


def _literal(values: dict[str, int], key: Column) -> Column:
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items())
    return F.try_element_at(F.create_map(*pairs), key)


def _age(stored_at: Column, as_of: Column) -> Column:
    """Microseconds between two points in time."""
    return F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(stored_at.cast("timestamp"))


def is_fresh(kind: Column, stored_at: Column, as_of: Column) -> Column:
    """True while the age does not exceed the time to live of the kind."""
    return _age(stored_at, as_of) <= _literal(TTL_HOURS, kind) * F.lit(3_600_000_000)


def is_table_fresh(stored_at: Column, as_of: Column, days: int = TABLE_TTL_DAYS) -> Column:
    return _age(stored_at, as_of) <= F.lit(days * 86_400_000_000)


def age_minutes(stored_at: Column, as_of: Column) -> Column:
    """Whole minutes since a copy was stored, never negative."""
    return F.greatest(F.lit(0).cast("bigint"), F.floor(_age(stored_at, as_of) / F.lit(60_000_000)))


def is_stale(cadence: Column, snapshot_date: Column, as_of: Column) -> Column:
    """True when a snapshot is older than its cadence allows; null without a rule."""
    return F.datediff(as_of, snapshot_date) > _literal(CADENCE_DAYS, cadence)


def stale_reason(cadence: Column, snapshot_date: Column, as_of: Column) -> Column:
    reason = F.format_string(
        "%s snapshot is %d days old, expected at most %d",
        cadence,
        F.datediff(as_of, snapshot_date),
        _literal(CADENCE_DAYS, cadence),
    )
    return F.when(is_stale(cadence, snapshot_date, as_of), reason)


def newest_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The row with the largest order value per key.

    An aggregate, not a window: every task first reduces its rows to one per key,
    so a key with a third of all rows sends one row per task.  ``order`` has to be
    total for the result to be determined.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*columns)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def fallback_pick(
    snapshots: DataFrame, keys: Sequence[str], kind: str, stored_at: str, as_of: Column,
    order: Sequence[str] = (),
) -> DataFrame:
    """Newest copy per key; flagged stale, with its age, when it is no longer fresh.

    The newest copy is fresh exactly when any copy is, so one pick serves both.
    """
    newest = newest_per_key(snapshots, keys, [stored_at, *order])
    fresh = F.coalesce(is_fresh(F.col(kind), F.col(stored_at), as_of), F.lit(False))
    return newest.select(
        "*",
        (~fresh).alias("stale"),
        F.when(~fresh, age_minutes(F.col(stored_at), as_of)).alias("age_minutes"),
    )


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Current rows with changed keys replaced: the newest row per key wins."""
    return newest_per_key(current.unionByName(changes), keys, order)


def year_in_text(col: Column) -> Column:
    """Largest run of four digits in a text as a number, or null."""
    years = F.regexp_extract_all(col, F.lit(r"(\d{4})"), F.lit(1))
    return F.array_max(F.transform(years, lambda y: y.cast("int")))


def latest_resource(
    resources: DataFrame,
    package: str,
    name: str,
    ordinal: str,
    exact: str | None = None,
    pattern: str | None = None,
    fmt: str | None = None,
    format_column: str = "format",
) -> DataFrame:
    """Per package the matching resource with the highest year in its name.

    Names match exactly or by a pattern found anywhere; of equal years the one
    listed first wins.
    """
    if (exact is None) == (pattern is None):
        raise ValueError("give either an exact name or a pattern")
    rows = resources.where(F.col(name) == exact if exact is not None else F.col(name).rlike(pattern))
    if fmt and fmt.strip():
        rows = rows.where(F.lower(F.trim(F.col(format_column))) == fmt.strip().lower())
    rows = rows.withColumn("year", F.coalesce(year_in_text(F.col(name)), F.lit(0)))
    return newest_per_key(rows, [package], ["year", -F.col(ordinal)])


def latest_package(
    packages: DataFrame, organisation: str, name: str, ordinal: str, pattern: str
) -> DataFrame:
    """Per organisation the package whose captured year is highest.

    The pattern is anchored at the start of the name; its first group is the year.
    """
    anchored = f"^(?:{pattern})"
    rows = packages.where(F.col(name).rlike(anchored))
    if re.compile(pattern).groups:
        year = F.regexp_extract(F.col(name), anchored, 1).try_cast("int")
    else:
        year = F.lit(None).cast("int")
    rows = rows.withColumn("year", F.coalesce(year, F.lit(0)))
    return newest_per_key(rows, [organisation], ["year", -F.col(ordinal)])


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_allowed(url: Column, host: str = PORTAL_HOST) -> Column:
    """True for http(s) addresses on a host or one of its subdomains."""
    web = url.startswith("http://") | url.startswith("https://")
    where = url_host(url)
    return F.coalesce(web & ((where == host) | where.endswith("." + host)), F.lit(False))


def dated_pick(
    dates: DataFrame, column: str, as_of: Column, lookback_days: int, default: Column | None = None
) -> DataFrame:
    """Newest date within the lookback window (both ends included), else the default."""
    inside = F.col(column).between(F.date_sub(as_of, lookback_days), as_of)
    newest = F.max(F.when(inside, F.col(column)))
    return dates.agg((F.coalesce(newest, default) if default is not None else newest).alias(column))


def resolve(
    specs: DataFrame,
    dated: DataFrame | None,
    listed: DataFrame | None,
    key: str,
    url: str,
    default: str,
    host: str = PORTAL_HOST,
) -> DataFrame:
    """Address per spec: a dated pick, else a listed one on an allowed host, else the default."""
    out = specs
    picks: list[Column] = []
    for label, side in (("_dated", dated), ("_listed", listed)):
        if side is None:
            continue
        side = side.select(F.col(key), F.col(url).alias(label))
        if label == "_listed":
            side = side.where(host_allowed(F.col(label), host))
        out = out.join(side, key, "left")
        picks.append(F.col(label))
    return out.select(
        *[F.col(c) for c in specs.columns],
        F.coalesce(*picks, F.col(default)).alias("resolved"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and order-free content hash of a table, for change detection.

    XOR alone cancels pairs of equal rows, so a sum is kept beside it.
    """
    row = F.xxhash64(*(columns or df.columns))
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("hash_sum"),
    )


def portable_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fingerprint any SQL engine can repeat: sum of a 60-bit prefix of each row's MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    prefix = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(prefix), F.lit(0)).cast("string").alias("hash_sum"),
    )


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: do two fingerprints of the same columns differ?"""
    names = before.columns
    other = after.select(F.struct(*names)).scalar()
    return before.select((~F.struct(*names).eqNullSafe(other)).alias("changed"))
