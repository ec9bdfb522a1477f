"""Quality rules: a table of thresholds compiled into one projection.

Measures are array and string expressions of Spark, evaluated inside each row, so a
document of any length costs one row's memory and nothing is shuffled.

Edge cases: a null or empty text has no words and no lines, fails the base rule and is
not kept; a null id stays null; repeated rows are judged one by one; columns other
than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.llm.shared import let

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with as was on be by this are or from at "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au avec ne "
    "el y los del se las por con para al lo como su no más o"
)
#: Up to so many words a window's hash and place share one long; beyond, a struct.
PACKED_WORDS = 1 << 17


@dataclass(frozen=True)
class Rule:
    """``measure`` (over ``per``, if named) must stand in relation ``sign`` to ``limit``."""

    name: str
    measure: str
    sign: str
    limit: float
    per: str | None = None


#: The threshold table. Ratios are compared without division: measure (sign) limit * per.
RULES = (
    Rule("long_enough", "n_words", ">=", 50),
    Rule("few_repeats", "n_repeat_words", "<=", 0.5, "n_words"),
    Rule("words_not_tiny", "word_chars", ">=", 2.0, "n_words"),
    Rule("words_not_huge", "word_chars", "<=", 15.0, "n_words"),
    Rule("few_symbols", "n_symbols", "<=", 0.1, "n_words"),
    Rule("has_stop_words", "n_stop_words", ">=", 0.02, "n_words"),
    Rule("few_repeated_lines", "n_dup_lines", "<=", 0.5, "n_lines"),
    Rule("few_list_lines", "n_list_lines", "<=", 0.9, "n_lines"),
    Rule("few_cut_lines", "n_cut_lines", "<=", 0.5, "n_lines"),
)
_SIGNS = {">=": operator.ge, "<=": operator.le}


def _long(column: Column) -> Column:
    return column.cast("bigint")


def _covered(places: Column) -> Column:
    """Words covered by 3-word windows that start at the given sorted places."""
    steps = F.transform(
        places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _twins(ordered: Column, same, place) -> Column:
    """Places of sorted entries whose neighbour holds the same window."""
    hits = F.filter(
        ordered,
        lambda x, i: F.coalesce(same(x, F.get(ordered, i + 1)), F.lit(False))
        | F.coalesce((i > 0) & same(x, F.get(ordered, F.greatest(i - 1, F.lit(0)))), F.lit(False)),
    )
    return F.sort_array(F.transform(hits, place))


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more among ``words``."""

    def of_windows(windows: Column) -> Column:
        n = F.size(windows)
        bits = F.ceil(F.log2(n + 1)).cast("int")

        def packed(b: Column) -> Column:
            keep = F.transform(windows, lambda h, i: _shl(h, b).bitwiseOR(_long(i)))
            return let(
                F.sort_array(keep),
                lambda s: let(
                    _twins(
                        s,
                        lambda x, y: _shr(x, b) == _shr(y, b),
                        lambda x: x.bitwiseAND(_shl(F.lit(1).cast("bigint"), b) - 1),
                    ),
                    _covered,
                ),
            )

        wide = let(
            F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), _long(i).alias("i")))),
            lambda s: let(_twins(s, lambda x, y: x["h"] == y["h"], lambda x: x["i"]), _covered),
        )
        return (
            F.when(F.size(F.array_distinct(windows)) == n, F.lit(0).cast("bigint"))
            .when(n < PACKED_WORDS, let(bits, packed))
            .otherwise(wide)
        )

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)),
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(let(windows, of_windows))


def _shl(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def _shr(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)


def measures(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per document; lines are ``\\n``-split pieces with a word."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(body, F.lit(SPACES))
    no_words = F.expr("cast(array() as array<string>)")
    words = F.when(bare == "", no_words).otherwise(F.split(bare, SPACE_RUN, -1))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    stops = sorted(set(STOP_WORDS.split()))

    def of_words(w: Column) -> Column:
        return F.struct(
            _long(F.size(w)).alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            _long(F.size(F.filter(w, lambda x: F.lower(x).isin(stops)))).alias("n_stop_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            _long(F.size(x)).alias("n_lines"),
            _long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            _long(F.size(F.filter(x, lambda s: s.rlike(r"^\s*[-*•]\s")))).alias("n_list_lines"),
            _long(F.size(F.filter(x, lambda s: s.rlike(r"(\.\.\.|…)\s*$")))).alias("n_cut_lines"),
        )

    counted = docs.select(
        F.col(id).alias("doc_id"),
        let(words, of_words).alias("w"),
        _long(F.length(F.translate(body, SPACES, ""))).alias("word_chars"),
        _long(F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).alias("n_symbols"),
        let(lines, of_lines).alias("l"),
    )
    return counted.select("doc_id", "w.*", "word_chars", "n_symbols", "l.*")


def verdict(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """The table as columns: one boolean per rule."""
    return [
        _SIGNS[r.sign](F.col(r.measure), F.lit(r.limit) * (F.col(r.per) if r.per else F.lit(1))).alias(r.name)
        for r in rules
    ]


def quality_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts, one boolean per rule, ``base_failed`` and ``kept`` for every document."""
    counted = measures(docs, id, text)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counted.select("*", base.alias("base_failed"), *verdict(rules))
    passed = F.lit(True)
    for rule in rules:
        passed = passed & F.col(rule.name)
    return judged.withColumn("kept", ~F.col("base_failed") & passed)
