"""Fuzzy lookup and alias translation on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.operators import lookup
from musterroll.operators import search as fuzzy
from musterroll.specs.tables import ORDERS
from musterroll.workload.base import check, load

QUERY = "blue bolt"


def _common(left: str, right: str) -> str:
    """SQL for the common subsequence length of two text expressions."""
    full = f"((1::BIGINT << length({left})) - 1)"
    marks = (
        f"list_transform(string_split({right}, ''), lambda ch: coalesce(list_sum(list_transform("
        f"range(length({left})), lambda i: CASE WHEN substr({left}, CAST(i + 1 AS INT), 1) = ch "
        f"THEN 1::BIGINT << CAST(i AS INT) ELSE 0 END)), 0)::BIGINT)"
    )
    end = (
        f"list_reduce({marks}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    )
    return f"(length({left}) - bit_count({end}))"


def _token_set(tokens: str) -> str:
    """SQL for the word-wise score of the query against the words in a list column."""
    mine = "[" + ", ".join(f"'{w}'" for w in sorted(set(QUERY.split()))) + "]"
    return f"""
        SELECT *, CASE
            WHEN len({tokens}) = 0 THEN 0.0
            WHEN shared <> '' AND (lft = '' OR rgt = '') THEN 100.0
            WHEN shared = '' THEN differing
            ELSE greatest(differing,
                100.0 - 100.0 * (1 + length(lft)) / (2 * length(shared) + 1 + length(lft)),
                100.0 - 100.0 * (1 + length(rgt)) / (2 * length(shared) + 1 + length(rgt))) END
            AS {tokens}_score
        FROM (
            SELECT *, 100.0 - 100.0 * (length(lft) + length(rgt) - 2 *
                CASE WHEN lft = '' OR rgt = '' THEN 0 ELSE {_common('lft', 'rgt')} END)
                / greatest(1, 2 * (length(shared) + CASE WHEN shared <> '' THEN 1 ELSE 0 END)
                   + length(lft) + length(rgt)) AS differing
            FROM (
                SELECT * EXCLUDE (shared, lft, rgt, differing),
                    array_to_string(list_filter({mine}, lambda w: list_contains({tokens}, w)), ' ')
                        AS shared,
                    array_to_string(list_filter({mine},
                        lambda w: NOT list_contains({tokens}, w)), ' ') AS lft,
                    array_to_string(list_filter({tokens},
                        lambda w: NOT list_contains({mine}, w)), ' ') AS rgt
                FROM stage
            )
        )
    """


def _words(text: str) -> str:
    return f"list_sort(list_distinct(string_split({text}, ' ')))"


_WINDOW = (
    f"substr(nm, CAST(greatest(i, 0) + 1 AS INT), "
    f"CAST(least(i + {len(QUERY)}, length(nm)) - greatest(i, 0) AS INT))"
)
_PARTIAL = (
    f"list_max(list_transform(range({1 - len(QUERY)}, length(nm)), lambda i: "
    f"200.0 * {_common(repr(QUERY), _WINDOW)} / ({len(QUERY)} + length({_WINDOW}))))"
)
_RELEVANCE = f"""
    WITH texts AS (
        SELECT p_partkey, p_name, lower(p_brand || ' ' || p_name) AS nm,
               lower(p_brand || ' ' || p_name || ' ' || p_type) AS kw
        FROM part
    ), start AS (
        SELECT *, {_words('nm')} AS name_words, {_words('kw')} AS keyword_words,
               '' AS shared, '' AS lft, '' AS rgt, 0.0 AS differing
        FROM texts
    ), named AS ({_token_set('name_words').replace('FROM stage', 'FROM start')}),
    keyed AS ({_token_set('keyword_words').replace('FROM stage', 'FROM named')}),
    raw AS (
        SELECT p_partkey, p_name, greatest(name_words_score, {_PARTIAL}) AS name_score,
               keyword_words_score * 0.4
                   + CASE WHEN contains(kw, '{QUERY}') THEN 15.0 ELSE 0.0 END AS rest
        FROM keyed
    ), top AS (
        SELECT *, name_score + rest AS score FROM raw
        ORDER BY name_score + rest DESC, name_score DESC, p_partkey LIMIT 50
    )
    SELECT p_partkey, p_name,
           round(greatest(0, score / (SELECT greatest(max(score), 100.0) FROM top) * 100), 1)
               AS relevance
    FROM top
"""


@check(_RELEVANCE)
def relevance_rank(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat_ws(" ", "p_brand", "p_name")
    hits = fuzzy.relevance(
        load(spark, folder, "part"), QUERY,
        name=name, keywords=F.concat_ws(" ", name, "p_type"), limit=50, tiebreak=["p_partkey"],
    )
    return hits.select("p_partkey", "p_name", "relevance")


@check("""
    SELECT c_name, round(1 - levenshtein(c_name, 'Custmer#000000721')
               / greatest(length(c_name), 17)::DOUBLE, 6) AS similarity
    FROM (SELECT DISTINCT c_name FROM customer)
    WHERE 1 - levenshtein(c_name, 'Custmer#000000721') / greatest(length(c_name), 17)::DOUBLE >= 0.7
    ORDER BY levenshtein(c_name, 'Custmer#000000721') / greatest(length(c_name), 17)::DOUBLE,
             c_name DESC LIMIT 5
""")
def closest_by_edits(spark: SparkSession, folder: str) -> DataFrame:
    near = fuzzy.closest_by_edits(load(spark, folder, "customer"), "c_name", "Custmer#000000721", 5)
    return near.withColumn("similarity", F.round("similarity", 6))


WORD = "Custmer#000000721"


def _longest_block(alo: str, ahi: str, blo: str, bhi: str) -> str:
    """SQL for the longest equal stretch of two text ranges: its length and places.

    Places are negated so that the first one is the largest among equal lengths.
    """
    prefix = (
        f"list_max(list_filter(range(0, least({ahi} - i, {bhi} - j) + 1), lambda n: "
        f"substr(a, CAST(i + 1 AS INT), CAST(n AS INT)) = "
        f"substr('{WORD}', CAST(j + 1 AS INT), CAST(n AS INT))))"
    )
    return (
        f"list_max(list_transform(range({alo}, {ahi}), lambda i: list_max(list_transform("
        f"range({blo}, {bhi}), lambda j: {{'k': {prefix}, 'i': -i, 'j': -j}}))))"
    )


@check(f"""
    WITH RECURSIVE names AS (SELECT DISTINCT c_name AS a FROM customer WHERE c_name IS NOT NULL),
    blocks AS (
        SELECT a, 0::BIGINT AS alo, length(a) AS ahi, 0::BIGINT AS blo,
               {len(WORD)}::BIGINT AS bhi, {_longest_block('0', 'length(a)', '0', str(len(WORD)))} AS m
        FROM names
        UNION ALL
        SELECT a, c.alo, c.ahi, c.blo, c.bhi,
               {_longest_block('c.alo', 'c.ahi', 'c.blo', 'c.bhi')} AS m
        FROM (
            SELECT a, unnest([
                {{'alo': alo, 'ahi': -m.i, 'blo': blo, 'bhi': -m.j}},
                {{'alo': m.k - m.i, 'ahi': ahi, 'blo': m.k - m.j, 'bhi': bhi}}]) AS c
            FROM blocks WHERE m.k > 0
        ) WHERE c.alo < c.ahi AND c.blo < c.bhi
    )
    SELECT a AS c_name, round(2.0 * sum(m.k) / (length(a) + {len(WORD)}), 6)::DOUBLE AS similarity
    FROM blocks GROUP BY a
    HAVING 2.0 * sum(m.k) / (length(a) + {len(WORD)}) >= 0.7
    ORDER BY 2.0 * sum(m.k) / (length(a) + {len(WORD)}) DESC, a DESC LIMIT 5
""")
def closest_values(spark: SparkSession, folder: str) -> DataFrame:
    near = fuzzy.closest_values(load(spark, folder, "customer"), "c_name", WORD, 5)
    return near.withColumn("similarity", F.round("similarity", 6))


@check("""
    SELECT o_orderkey, written,
           CASE written WHEN 'closed' THEN 'F' WHEN 'O' THEN 'O' END AS status
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'O'
                 ELSE 'pend' END AS written FROM orders)
""")
def enum_translate(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    written = F.when(status == "F", "closed").when(status == "O", "O").otherwise("pend")
    orders = load(spark, folder, "orders").select("o_orderkey", written.alias("written"))
    return orders.withColumn(
        "status", lookup.translate_column(F.col("written"), ORDERS.enums["status"])
    )


@check("""
    SELECT c_custkey, n_name AS nation FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0
""")
def lookup_table(spark: SparkSession, folder: str) -> DataFrame:
    names = load(spark, folder, "nation").where(F.col("n_regionkey") != 0)
    return lookup.lookup_join(
        load(spark, folder, "customer"), "c_nationkey", names, "n_nationkey", "n_name", "nation"
    ).select("c_custkey", "nation")


@check("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open'
                            ELSE o_orderstatus END AS status
    FROM orders
""")
def reverse_label(spark: SparkSession, folder: str) -> DataFrame:
    enum = {"filled": "F", "closed": "F", "open": "O"}
    shown = lookup.label_column(F.col("o_orderstatus"), enum)
    return load(spark, folder, "orders").select("o_orderkey", shown.alias("status"))
