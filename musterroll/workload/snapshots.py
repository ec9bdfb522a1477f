"""Snapshot, resource and freshness choices on the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators import snapshots as S
from musterroll.workload.base import check, load

AS_OF = "2024-01-31 00:00:00"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _copies(spark: SparkSession, folder: str) -> DataFrame:
    """Events as stored copies: a key, a kind, a cadence and a time of storage."""
    kind = F.col("event_type")
    return load(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("key"),
        F.when(kind == "click", "data").when(kind == "view", "latest")
        .when(kind == "signup", "catalog").when(kind == "purchase", "register").alias("kind"),
        F.when(kind == "click", "weekly").when(kind == "view", "monthly").alias("cadence"),
        F.col("ts").alias("stored_at"),
    )


_COPIES = """
    SELECT event_id, user_id AS key, ts AS stored_at,
           CASE event_type WHEN 'click' THEN 'data' WHEN 'view' THEN 'latest'
                WHEN 'signup' THEN 'catalog' WHEN 'purchase' THEN 'register' END AS kind,
           CASE event_type WHEN 'click' THEN 'weekly' WHEN 'view' THEN 'monthly' END AS cadence,
           CASE event_type WHEN 'click' THEN 24 WHEN 'view' THEN 6
                WHEN 'signup' THEN 1 WHEN 'purchase' THEN 24 END AS ttl,
           CASE event_type WHEN 'click' THEN 14 WHEN 'view' THEN 45 END AS days,
           date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS age,
           epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) AS age_us
    FROM events
"""


@check(f"""
    SELECT event_id, age_us <= ttl * 3600000000 AS fresh, age > days AS stale,
           age_us <= 14 * 86400000000 AS table_fresh,
           CASE WHEN age > days THEN cadence || ' snapshot is ' || age
                || ' days old, expected at most ' || days END AS reason
    FROM ({_COPIES})
""")
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    day, today = F.to_date("stored_at"), F.to_date(_as_of())
    return _copies(spark, folder).select(
        "event_id",
        S.is_fresh(F.col("kind"), F.col("stored_at"), _as_of()).alias("fresh"),
        S.is_stale(F.col("cadence"), day, today).alias("stale"),
        S.is_table_fresh(F.col("stored_at"), _as_of()).alias("table_fresh"),
        S.stale_reason(F.col("cadence"), day, today).alias("reason"),
    )


@check(f"""
    SELECT key, event_id, kind, coalesce(age_us > ttl * 3600000000, TRUE) AS stale,
           CASE WHEN coalesce(age_us > ttl * 3600000000, TRUE)
                THEN greatest(0, age_us // 60000000) END AS age_minutes
    FROM ({_COPIES})
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY stored_at DESC, event_id DESC) = 1
""")
def fallback_pick(spark: SparkSession, folder: str) -> DataFrame:
    picked = S.fallback_pick(
        _copies(spark, folder), ["key"], "kind", "stored_at", _as_of(), order=["event_id"]
    )
    return picked.select("key", "event_id", "kind", "stale", "age_minutes")


@check("""
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    current, changes = events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)
    merged = S.upsert(current, changes, ["user_id", "event_type"], ["ts", "event_id"])
    return merged.select("user_id", "event_type", "event_id", "value")


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"
_YEAR = """coalesce(list_max(list_transform(
    regexp_extract_all(url, '([0-9]{4})', 1), lambda y: CAST(y AS INT))), 0)"""


def _resources(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as resources of a package (their host), named by address."""
    pages = load(spark, folder, "pages")
    # ids padded with zeros give every name a run of at least four digits
    name = F.concat(F.col("url"), F.lit("/"), F.lpad(F.col("page_id").cast("string"), 5, "0"))
    form = F.when(F.col("url").contains("?"), F.lit(" CSV ")).otherwise("xlsx")
    return pages.select("page_id", S.url_host(F.col("url")).alias("host"), name.alias("name"),
                        form.alias("format"))


_RESOURCES = f"""
    SELECT page_id, {_HOST} AS host, url || '/' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS name,
           CASE WHEN contains(url, '?') THEN 'csv' ELSE 'xlsx' END AS format
    FROM pages
"""


@check(f"""
    SELECT host, page_id, name, {_YEAR.replace('url', 'name')} AS year
    FROM ({_RESOURCES}) WHERE format = 'csv' AND regexp_matches(name, '/(en|de)/')
    QUALIFY row_number() OVER (PARTITION BY host ORDER BY year DESC, page_id) = 1
""")
def latest_resource(spark: SparkSession, folder: str) -> DataFrame:
    picked = S.latest_resource(
        _resources(spark, folder), "host", "name", "page_id", pattern="/(en|de)/", fmt="Csv"
    )
    return picked.select("host", "page_id", "name", "year")


@check(f"""
    SELECT organisation, page_id, slug, CAST(regexp_extract(slug, '^page-([0-9]+)-', 1) AS INT) AS year
    FROM (SELECT regexp_extract({_HOST}, '[a-z]+$') AS organisation, page_id,
                 CASE WHEN contains(url, '/en/') THEN 'page-' ELSE 'old-page-' END
                 || regexp_extract(url, '/([0-9]+)', 1) || '-x' AS slug
          FROM pages)
    WHERE regexp_matches(slug, '^page-([0-9]+)-')
    QUALIFY row_number() OVER (PARTITION BY organisation ORDER BY year DESC, page_id) = 1
""")
def latest_package(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    slug = F.concat(
        F.when(url.contains("/en/"), "page-").otherwise("old-page-"),
        F.regexp_extract(url, "/([0-9]+)", 1), F.lit("-x"),
    )
    packages = load(spark, folder, "pages").select(
        F.regexp_extract(S.url_host(url), "[a-z]+$", 0).alias("organisation"),
        "page_id", slug.alias("slug"),
    )
    picked = S.latest_package(packages, "organisation", "slug", "page_id", r"page-(\d+)-")
    return picked.select("organisation", "page_id", "slug", "year")


@check(f"""
    SELECT page_id, url, coalesce(regexp_matches(url, '^https?://')
               AND (host = 'example.com' OR ends_with(host, '.example.com')), FALSE) AS allowed
    FROM (SELECT *, {_HOST} AS host FROM pages)
""")
def host_allowed(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "pages").select(
        "page_id", "url", S.host_allowed(F.col("url"), "example.com").alias("allowed")
    )


@check(f"""
    WITH hosts AS (SELECT DISTINCT {_HOST} AS host FROM pages),
    listed AS (
        SELECT {_HOST} AS host, url FROM pages
        WHERE contains(url, '/en/')
        QUALIFY row_number() OVER (PARTITION BY {_HOST} ORDER BY {_YEAR} DESC, page_id) = 1
    )
    SELECT h.host, CASE WHEN ends_with(h.host, '.example.com') AND l.url IS NOT NULL THEN l.url
                        ELSE 'default:' || h.host END AS resolved
    FROM hosts h LEFT JOIN listed l ON h.host = l.host
""")
def resolve_default(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages").withColumn("host", S.url_host(F.col("url")))
    specs = pages.select("host").distinct().withColumn(
        "address", F.concat(F.lit("default:"), F.col("host"))
    )
    listed = S.latest_resource(pages, "host", "url", "page_id", pattern="/en/")
    return S.resolve(specs, None, listed, "host", "url", "address", "example.com").select(
        "host", "resolved"
    )


@check(f"""
    WITH hosts AS (
        SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS INT) % 40 AS n FROM (SELECT DISTINCT {_HOST} AS host FROM pages)
    ), listed AS (
        SELECT {_HOST} AS host, url FROM pages
        WHERE contains(url, '/en/')
        QUALIFY row_number() OVER (PARTITION BY {_HOST} ORDER BY {_YEAR} DESC, page_id) = 1
    ), dated AS (
        SELECT o_custkey % 40 AS n, max(o_orderdate) AS day FROM orders
        WHERE o_orderdate >= DATE '1998-07-02' AND o_orderdate < DATE '1998-07-13' GROUP BY 1
    )
    SELECT h.host, coalesce(strftime(d.day, 'day-%Y%m%d.csv'),
               CASE WHEN ends_with(h.host, '.example.com') THEN l.url END, 'default:' || h.host) AS resolved
    FROM hosts h LEFT JOIN listed l ON h.host = l.host LEFT JOIN dated d ON d.n = h.n AND h.n % 2 = 0
""")
def resolve_dated(spark: SparkSession, folder: str) -> DataFrame:
    """Some hosts have daily files: the newest within ten days, else their listed page, else the default."""
    pages = load(spark, folder, "pages").withColumn("host", S.url_host(F.col("url")))
    number = F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("bigint") % 40
    specs = pages.select("host").distinct().withColumn("address", F.concat(F.lit("default:"), F.col("host")))
    days = load(spark, folder, "orders").select((F.col("o_custkey") % 40).alias("n"), F.to_date("o_orderdate").alias("day"))
    as_of = F.lit("1998-07-12").cast("date")
    inside = days.where(F.col("day").between(F.date_sub(as_of, 10), as_of)).groupBy("n").agg(F.max("day").alias("day"))
    dated = specs.select("host", number.alias("n")).where(F.col("n") % 2 == 0).join(inside, "n")
    dated = dated.select("host", F.date_format("day", "'day-'yyyyMMdd'.csv'").alias("url"))
    listed = S.latest_resource(pages, "host", "url", "page_id", pattern="/en/")
    return S.resolve(specs, dated, listed, "host", "url", "address", "example.com").select("host", "resolved")


@check("""
    SELECT 'inside' AS window_name, strftime(max(o_orderdate), '%Y-%m-%d') AS day FROM orders
    WHERE o_orderdate >= DATE '1999-05-10' AND o_orderdate <= DATE '1999-05-20'
    UNION ALL
    SELECT 'outside', '1900-01-01' FROM orders WHERE o_orderdate < DATE '2030-01-01' GROUP BY 2
""")
def dated_pick(spark: SparkSession, folder: str) -> DataFrame:
    days = load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))

    def pick(label: str, as_of: str) -> DataFrame:
        default = F.lit("1900-01-01").cast("date")
        one = S.dated_pick(days, "day", F.lit(as_of).cast("date"), 10, default)
        return one.select(
            F.lit(label).alias("window_name"), F.date_format("day", "yyyy-MM-dd").alias("day")
        )

    return pick("inside", "1999-05-20").unionByName(pick("outside", "2030-01-01"))


@check("""
    SELECT count(*) AS row_count,
           CAST(sum(CAST('0x' || substr(md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus
               || '|' || o_orderpriority), 1, 15) AS HUGEINT)) AS VARCHAR) AS hash_sum
    FROM orders
""")
def fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return S.portable_fingerprint(load(spark, folder, "orders"), columns)


@check("""
    SELECT 'same' AS comparison, (SELECT count(*) < 0 FROM orders) AS changed
    UNION ALL
    SELECT 'edited', (SELECT count(*) > 0 FROM orders WHERE o_orderstatus = 'P')
""")
def fingerprint_change(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    edited = orders.withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus")),
    )
    before = S.fingerprint(orders)
    same = S.changed(before, S.fingerprint(orders.orderBy("o_totalprice")))
    differs = S.changed(before, S.fingerprint(edited))
    return same.select(F.lit("same").alias("comparison"), "changed").unionByName(
        differs.select(F.lit("edited").alias("comparison"), "changed")
    )
