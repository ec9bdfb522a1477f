"""Fuzzy lookup: ranked relevance over any table, and closest values of a column."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.functions.similarity import Scorer, characters, with_bounds
from musterroll.operators.summaries import distinct_values
from musterroll.operators.topk import check_limit

# Weights of the relevance pools, and the largest number of hits.
KEYWORD_WEIGHT = 0.4
DESCRIPTION_WEIGHT = 0.3
DESCRIPTION_CAP = 30.0
PHRASE_BONUS = 15.0
SHORT_QUERY_WORDS = 2
SCALE_FLOOR = 100.0
MAX_HITS = 50
VALUE_CUTOFF = 0.7

# How far rounding may take a score past its bounds.
SLACK = 1e-6


def check_query(query: object) -> str:
    if not isinstance(query, str):
        raise ValueError(f"query must be a string, got {type(query).__name__}")
    if not query.strip():
        raise ValueError("query is required")
    return query.lower()


def scored(
    df: DataFrame, query: str, name: Column, keywords: Column, description: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Every row with its raw relevance ``_raw`` and its name score ``_name``.

    With ``where`` only rows that meet it are scored; the others have null scores.

    The name counts most; keywords (which include the name) and description
    broaden recall with less weight; the query as a phrase earns a bonus.  Short
    queries also match parts of words in the name.
    """
    text = check_query(query)
    scorer = Scorer(text)
    name, keywords = F.lower(name), F.lower(keywords)
    name_score = scorer.token_set(name)
    if len(text.split()) <= SHORT_QUERY_WORDS:
        name_score = F.greatest(name_score, scorer.partial(name))
    meets = F.lit(True) if where is None else where
    words = scorer.token_set(keywords) * KEYWORD_WEIGHT
    phrase = F.when(keywords.contains(text), F.lit(PHRASE_BONUS)).otherwise(0.0)
    extra = words + phrase
    if description is not None:
        weighted = F.coalesce(scorer.weighted(F.lower(description), DESCRIPTION_CAP), F.lit(0.0))
        extra = extra + weighted * DESCRIPTION_WEIGHT
    out = df.withColumn("_name", F.when(meets, name_score))
    return out.withColumn("_raw", F.when(meets, F.col("_name") + extra))


def bounded(
    df: DataFrame, query: str, name: Column, keywords: Column, description: Column | None = None
) -> DataFrame:
    """Every row with ``_low`` and ``_high``, between which its raw relevance lies.

    Whole words and the phrase count exactly; how well the rest may match follows from
    the characters that text and query share.
    """
    text = check_query(query)
    rows = df.withColumns({"_text": F.lower(name), "_words": F.lower(keywords)})
    rows = with_bounds(rows, text, "_text", partial=len(text.split()) <= SHORT_QUERY_WORDS, into="_text")
    rows = with_bounds(rows, text, "_words", partial=False, into="_words")
    phrase = F.when(F.col("_words").contains(text), F.lit(PHRASE_BONUS)).otherwise(0.0)
    low = F.col("_text_low") + F.col("_words_low") * KEYWORD_WEIGHT + phrase
    high = F.col("_text_high") + F.col("_words_high") * KEYWORD_WEIGHT + phrase
    if description is not None:
        high = high + F.when(F.length(description) > 0, DESCRIPTION_CAP * DESCRIPTION_WEIGHT).otherwise(0.0)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], low.alias("_low"), high.alias("_high"))


def relevance(
    df: DataFrame,
    query: str,
    name: Column,
    keywords: Column,
    description: Column | None = None,
    limit: int = 10,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The best rows for a query, with ``relevance`` from 0 to 100.

    Cheap bounds first: the ``limit``-th best lower bound is a floor that no hit falls
    below, and only rows whose upper bound reaches it are scored in full.  Each task
    keeps its best ``limit`` rows, and only those few are scaled against the leader.
    """
    check_limit(limit, MAX_HITS)
    rows = bounded(df, query, name, keywords, description)
    best = rows.select("_low").orderBy(F.col("_low").desc()).limit(limit)
    floor = best.agg(F.when(F.count("_low") == limit, F.min("_low") - SLACK)).scalar()
    # rows without a bound, and all rows where there are too few for a floor, are scored; a
    # filter would be pushed below the steps of the bounds and work them out many times
    rows = rows.withColumn("_open", F.coalesce(F.col("_high") >= floor, F.lit(True)))
    hits = (
        scored(rows, query, name, keywords, description, F.col("_open"))
        .orderBy(F.col("_raw").desc(), F.col("_name").desc(), *tiebreak)
        .limit(limit)
        .drop("_low", "_high", "_open")
    )
    rows = hits.agg(
        F.greatest(F.max("_raw"), F.lit(SCALE_FLOOR)).alias("_top"),
        F.collect_list(F.struct(*hits.columns)).alias("_hits"),
    ).select("_top", F.inline("_hits"))
    scaled = F.greatest(F.lit(0.0), F.col("_raw") / F.col("_top") * 100)
    return rows.withColumn("relevance", F.round(scaled, 1)).drop("_top")


def _quick_bound(word: str, col: Column) -> Column:
    """Upper bound of the matching-block similarity, from character counts alone."""
    shared = F.lit(0)
    for ch, n in Counter(word).items():
        found = F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))
        shared = shared + F.least(F.lit(n), found)
    return F.lit(2.0) * shared / (F.length(col) + len(word))


def _length_bound(word: str, col: Column) -> Column:
    n = F.length(col)
    return F.lit(2.0) * F.least(n, F.lit(len(word))) / (n + len(word))


def matching_blocks(a: str, b: str) -> str:
    """SQL for how many characters of two character columns lie in matching blocks.

    The longest stretch both have, the first of equal ones, then the same to its left and
    to its right: a stack of ranges, each looked through by the table of run lengths.
    """
    place = f"IF(element_at({b}, j + 1) = element_at({a}, i + 1), IF(j = r.bl, 0, element_at(s.p, j - r.bl)) + 1, 0)"
    longest = (
        "aggregate(sequence(r.al, r.ah - 1),"
        " named_struct('p', transform(sequence(r.bl, r.bh - 1), j -> 0), 'k', 0, 'i', r.al, 'j', r.bl),"
        f" (s, i) -> transform(array(transform(sequence(r.bl, r.bh - 1), j -> {place})), n -> transform(array(array_max(n)), m ->"
        " IF(m > s.k, named_struct('p', n, 'k', m, 'i', i - m + 1, 'j', r.bl + CAST(array_position(n, m) AS INT) - m),"
        " named_struct('p', n, 'k', s.k, 'i', s.i, 'j', s.j)))[0])[0])"
    )
    beside = (
        "filter(array(named_struct('al', r.al, 'ah', f.i, 'bl', r.bl, 'bh', f.j),"
        " named_struct('al', f.i + f.k, 'ah', r.ah, 'bl', f.j + f.k, 'bh', r.bh)), x -> x.al < x.ah AND x.bl < x.bh)"
    )
    rest = "slice(t.todo, 1, size(t.todo) - 1)"
    taken = (
        f"transform(array(element_at(t.todo, -1)), r -> transform(array({longest}), f -> IF(f.k = 0,"
        f" named_struct('todo', {rest}, 'n', t.n), named_struct('todo', concat({rest}, {beside}), 'n', t.n + f.k)))[0])[0]"
    )
    whole = f"array(named_struct('al', 0, 'ah', size({a}), 'bl', 0, 'bh', size({b})))"
    return (
        f"aggregate(sequence(1, 2 * least(size({a}), size({b})) + 1),"
        f" named_struct('todo', filter({whole}, x -> x.al < x.ah AND x.bl < x.bh), 'n', 0),"
        f" (t, turn) -> IF(size(t.todo) = 0, t, {taken}), t -> t.n)"
    )


def closest_values(
    df: DataFrame, column: str, word: str, n: int = 3, cutoff: float = VALUE_CUTOFF
) -> DataFrame:
    """The ``n`` values of a column most like a word, by matching blocks.

    Distinct values first; two cheap upper bounds drop most of them inside the
    scan stage; only the rest are compared block by block, by Spark expressions.
    """
    check_limit(n, None)
    if not word:
        raise ValueError("word is empty")
    value = F.col(column)
    near = distinct_values(df, column).where(
        (_length_bound(word, value) >= cutoff) & (_quick_bound(word, value) >= cutoff)
    )
    letters = near.withColumns({"_value": characters(value), "_word": F.lit(list(word))})
    matched = letters.withColumn("_matched", F.expr(matching_blocks("_value", "_word")))
    # not a filter: it would be pushed below and every block found twice
    scored = matched.select(value, (F.lit(2.0) * F.col("_matched") / (F.length(value) + len(word))).alias("similarity"))
    best = scored.orderBy(F.col("similarity").desc(), value.desc()).limit(n)
    return best.where(F.col("similarity") >= cutoff)


def closest_by_edits(
    df: DataFrame, column: str, word: str, n: int = 3, cutoff: float = VALUE_CUTOFF
) -> DataFrame:
    """Like :func:`closest_values` with edit distance: no Python, any SQL engine can check it."""
    check_limit(n, None)
    value = F.col(column)
    longest = F.greatest(F.length(value), F.lit(len(word)))
    shortest = F.least(F.length(value), F.lit(len(word)))
    score = F.lit(1.0) - F.levenshtein(value, F.lit(word)) / longest
    return (
        distinct_values(df, column)
        .where(shortest / longest >= cutoff)
        .withColumn("similarity", score)
        .where(F.col("similarity") >= cutoff)
        .orderBy(F.col("similarity").desc(), value.desc())
        .limit(n)
    )
