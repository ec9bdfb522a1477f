"""Text similarity as column expressions: one fixed query text against a column.

The scores follow the published definitions: the ratio of two texts is
``100 * 2 * L / (len(a) + len(b))`` with L the length of their longest common
subsequence; ``partial`` slides the shorter text over the longer; ``token set``
compares the shared and the differing words.

L is computed with the published bit-vector recurrence ``S' = (S + (S & M)) |
(S - (S & M))``, where M marks where a character of the column occurs in the
query.  One 64-bit word holds a query of up to 62 characters; longer queries use
the same recurrence on Python integers in an Arrow batch function.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 62
# What parts words.
SPACES = r"(?U)[\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it by name in ``body``.

    Inside higher-order functions Spark evaluates a repeated expression again for
    every element; a lambda variable is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def characters(col: Column) -> Column:
    return F.split(col, "")


def words(col: Column) -> Column:
    """Words of a text in sorted order, repeats included."""
    return F.sort_array(split_words(col))


def split_words(col: Column) -> Column:
    """Words of a text as they come; no function values, so this compiles."""
    return F.array_remove(F.split(F.regexp_replace(col, SPACES, " "), " "), "")


def query_words(query: str) -> list[str]:
    return sorted(set(query.split()))


def _common(marks: Column, region: Column) -> Column:
    """Common subsequence length of the query characters in ``region`` and a text.

    ``marks`` holds one bit set per text character; ``region`` is the bit set of
    the query positions that take part.
    """

    def step(state: Column, mark: Column) -> Column:
        hit = state.bitwiseAND(mark)
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(region)

    left = F.aggregate(marks, region, step)
    return F.bit_count(region) - F.bit_count(left)


def _query_marks(query: str, col: Column) -> Column:
    """Per character of the column, the bit set of its places in the query."""
    places: dict[str, int] = {}
    for i, ch in enumerate(query):
        places[ch] = places.get(ch, 0) | (1 << i)
    pairs = chain.from_iterable(
        (F.lit(ch), F.lit(bits).cast("bigint")) for ch, bits in places.items()
    )
    table = F.create_map(*pairs)
    none = F.lit(0).cast("bigint")
    return F.transform(characters(col), lambda ch: F.coalesce(F.try_element_at(table, ch), none))


def _bits(first: Column, count: Column) -> Column:
    """Bit set of ``count`` positions from ``first`` on."""
    one = F.lit(1).cast("bigint")
    ones = F.call_function("shiftleft", one, count.cast("int")) - one
    return F.call_function("shiftleft", ones, first.cast("int"))


def ratio(query: str, col: Column) -> Column:
    common = _common(_query_marks(query, col), F.lit((1 << len(query)) - 1).cast("bigint"))
    total = F.length(col) + len(query)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * common / total)


def _best(starts: Column, score: Callable[[Column], Column], enough: float | None) -> Column:
    top = F.array_max(F.transform(starts, score))
    if enough is None or enough > 100:
        return top
    reached = F.exists(starts, lambda s: score(s) >= enough)
    return F.when(reached, F.lit(float(enough))).otherwise(top)


def partial_ratio(query: str, col: Column, enough: float | None = None) -> Column:
    """Best ratio of the shorter text against any stretch of the longer one.

    Stretches also hang over either end.  With ``enough`` the search stops at the
    first stretch that reaches it, and the result is then ``enough``: used where a
    caller caps the score anyway.
    """
    if not query:
        return F.lit(0.0)
    n_query, n_text = F.lit(len(query)), F.length(col)
    whole = F.lit((1 << len(query)) - 1).cast("bigint")

    def in_text(marks: Column) -> Column:
        def score(start: Column) -> Column:
            low = F.greatest(start, F.lit(0))
            width = F.least(start + n_query, F.size(marks)) - low
            common = _common(F.slice(marks, low + 1, width), whole)
            return F.lit(200.0) * common / (n_query + width)

        # A stretch gains nothing from an end character the query lacks: the one beside
        # it, or without it, scores as well.  Stretches cut off by the end of the text
        # are asked for their first character, all others for their last.
        def worth(start: Column) -> Column:
            last = start + n_query
            edge = F.when(last <= F.size(marks), last).otherwise(start + 1)
            return F.element_at(marks, edge) != 0

        starts = F.filter(F.sequence(1 - n_query, F.size(marks) - 1), worth)
        return F.coalesce(_best(starts, score, enough), F.lit(0.0))

    def in_query(marks: Column) -> Column:
        def score(start: Column) -> Column:
            low = F.greatest(start, F.lit(0))
            width = F.least(start + F.size(marks), n_query) - low
            region = _bits(low, width)
            masked = F.transform(marks, lambda m: m.bitwiseAND(region))
            return F.lit(200.0) * _common(masked, region) / (F.size(marks) + width)

        return _best(F.sequence(1 - F.size(marks), n_query - 1), score, enough)

    def pick(marks: Column) -> Column:
        return (
            F.when(n_query < F.size(marks), in_text(marks))
            .when(n_query > F.size(marks), in_query(marks))
            .otherwise(F.greatest(in_text(marks), in_query(marks)))
        )

    return F.when(n_text == 0, F.lit(0.0)).otherwise(let(_query_marks(query, col), pick))


def _literal(text: str) -> str:
    """A text literal in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _compare_sql(shared: str, left: str, right: str, matched: str) -> str:
    """:func:`_compare` in SQL text, over columns with lengths."""
    gap = f"if({shared} > 0, 1, 0)"
    full = f"(2 * ({shared} + {gap}) + {left} + {right})"
    differing = f"100D - 100D * ({left} + {right} - 2 * {matched}) / greatest({full}, 1)"
    sides = [f"100D - 100D * ({gap} + {n}) / greatest(2 * {shared} + {gap} + {n}, 1)" for n in (left, right)]
    return (
        f"CASE WHEN {shared} > 0 AND ({left} = 0 OR {right} = 0) THEN 100D WHEN {shared} = 0 THEN {differing} "
        f"ELSE greatest({differing}, {', '.join(sides)}) END"
    )


def with_bounds(df: DataFrame, query: str, text: str, partial: bool, into: str) -> DataFrame:
    """``into`` with columns ``<into>_low`` and ``<into>_high`` around the scores of a text column.

    They hold :func:`token_set_ratio`, with ``partial`` the greater of it and
    :func:`partial_ratio`.  Words count exactly, characters in order by how many are shared
    at all.  Worked out in steps of plain columns, which compile; nothing is searched.
    """
    whole, kept = _literal(query), [f"`{c}`" for c in df.columns]
    own = f"array({', '.join(map(_literal, query_words(query)))})" if query.strip() else "cast(array() as array<string>)"
    spaces = _literal(SPACES)
    shared = [f"least({n}, length(`{text}`) - length(replace(`{text}`, {_literal(ch)}, '')))" for ch, n in sorted(Counter(query).items())]
    df = df.selectExpr(
        *kept, f"array_distinct(array_remove(split(regexp_replace(`{text}`, {spaces}, ' '), ' '), '')) AS _theirs",
        f"{' + '.join(shared) or '0'} AS _chars",
    )
    size = "length(array_join(array_{}, ' ')) AS {}"
    df = df.selectExpr(
        *kept, "_chars", "size(_theirs) = 0 AS _wordless", size.format(f"intersect({own}, _theirs)", "_shared"),
        size.format(f"except({own}, _theirs)", "_left"), size.format(f"except(_theirs, {own})", "_right"),
    )
    wordless = "_wordless" if query.strip() else "true"
    low, high = (
        f"CASE WHEN {wordless} THEN 0D ELSE {_compare_sql('_shared', '_left', '_right', m)} END"
        for m in ("0", "least(_left, _right, _chars)")
    )
    if partial and query:
        within = f"CASE WHEN length(`{text}`) > 0 AND (contains(`{text}`, {whole}) OR contains({whole}, `{text}`)) THEN 100D ELSE 0D END"
        reach = f"200D * _chars / greatest(least(length(`{text}`), {len(query)}) + _chars, 1)"
        low = f"greatest({low}, {within})"
        high = f"greatest({high}, {within}, CASE WHEN length(`{text}`) = 0 THEN 0D ELSE {reach} END)"
    return df.selectExpr(*kept, f"{low} AS {into}_low", f"{high} AS {into}_high")


def _compare(n_shared: Column, n_left: Column, n_right: Column, matched: Column) -> Column:
    """Word-wise score from the lengths of shared and differing words.

    ``matched`` characters of the differing ones agree in order.
    """
    gap = (n_shared > 0).cast("int")
    full_left, full_right = n_shared + gap + n_left, n_shared + gap + n_right

    def score(distance: Column, total: Column) -> Column:
        return F.lit(100.0) - F.lit(100.0) * distance / F.greatest(total, F.lit(1))

    differing = score(n_left + n_right - 2 * matched, full_left + full_right)
    return (
        F.when((n_shared > 0) & ((n_left == 0) | (n_right == 0)), F.lit(100.0))
        .when(n_shared == 0, differing)
        .otherwise(
            F.greatest(
                differing,
                score(gap + n_left, n_shared + full_left),
                score(gap + n_right, n_shared + full_right),
            )
        )
    )


def _split_words(query: str, col: Column, body: Callable[[Column], Column], empty: Column) -> Column:
    """``body`` of the words the query and the text share and those each has for itself."""
    own = F.array(*[F.lit(w) for w in query_words(query)])

    def parts(theirs: Column) -> Column:
        join = lambda a: F.concat_ws(" ", a)
        split = F.struct(
            join(F.array_intersect(own, theirs)).alias("shared"),
            join(F.array_except(own, theirs)).alias("left"),
            join(F.array_except(theirs, own)).alias("right"),
        )
        return F.when(F.size(theirs) == 0, empty).otherwise(let(split, body))

    return let(words(col), parts)


def token_set_ratio(query: str, col: Column) -> Column:
    """Ratio of shared and differing words, whatever their order and repetition."""
    if not query_words(query):
        return F.lit(0.0)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def common(letters: Column, text: Column) -> Column:
        # the pattern is what is left of the query in this row: at most the query
        def places(ch: Column) -> Column:
            hits = F.transform(
                letters, lambda own_ch, i: F.when(own_ch == ch, F.call_function("shiftleft", one, i)).otherwise(none)
            )
            return F.aggregate(hits, none, lambda a, b: a.bitwiseOR(b))

        return _common(F.transform(characters(text), places), _bits(F.lit(0), F.size(letters)))

    def compare(t: Column) -> Column:
        left, right = t["left"], t["right"]
        matched = F.when(
            (F.length(left) > 0) & (F.length(right) > 0), let(characters(left), lambda x: common(x, right))
        ).otherwise(0)
        return let(matched, lambda m: _compare(F.length(t["shared"]), F.length(left), F.length(right), m))

    return _split_words(query, col, compare, F.lit(0.0))


def token_sort_ratio(query: str, col: Column) -> Column:
    return ratio(" ".join(sorted(query.split())), F.concat_ws(" ", words(col)))


def weighted_ratio(query: str, col: Column, cap: float = 100.0) -> Column:
    """Best of the whole, partial and word-wise ratios, weighted by length gap.

    Never more than ``cap``: searches stop early once a part reaches it.
    """
    if not query:
        return F.lit(0.0)
    n_query, n_text = F.lit(len(query)), F.length(col)
    longer = F.greatest(n_query, n_text) / F.greatest(F.least(n_query, n_text), F.lit(1))
    near = F.greatest(token_sort_ratio(query, col), token_set_ratio(query, col)) * 0.95
    mine = query_words(query)
    shares_word = (
        F.arrays_overlap(F.array(*[F.lit(w) for w in mine]), words(col)) if mine else F.lit(False)
    )

    def far(scale: float) -> Column:
        needed = cap / scale
        in_order = partial_ratio(query, col, needed) * scale
        any_order = F.greatest(
            partial_ratio(
                " ".join(sorted(query.split())), F.concat_ws(" ", words(col)), needed / 0.95
            ),
            partial_ratio(
                " ".join(mine), F.concat_ws(" ", F.array_distinct(words(col))), needed / 0.95
            ),
        )
        by_word = F.when(shares_word, F.lit(100.0)).otherwise(any_order) * 0.95 * scale
        # a shared word alone may reach the cap; then nothing has to be searched
        return F.when(shares_word & F.lit(95.0 * scale >= cap), F.lit(float(cap))).otherwise(
            F.greatest(in_order, by_word)
        )

    gap = F.when(longer < 1.5, near).when(longer <= 8, far(0.9)).otherwise(far(0.6))
    # least and greatest pass over nulls: without a text there is no score
    return F.when(n_text == 0, F.lit(0.0)).when(
        n_text > 0, F.least(F.greatest(ratio(query, col), gap), F.lit(float(cap)))
    )


# -- queries longer than one machine word ------------------------------------


def _common_length(a: str, b: str) -> int:
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for ch in b:
        hit = state & places.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _plain_ratio(a: str, b: str) -> float:
    return 200.0 * _common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def _plain_partial(a: str, b: str, enough: float) -> float:
    if not a or not b:
        return 0.0
    short, long = sorted((a, b), key=len)
    best = 0.0
    for x, y in ((short, long), (long, short))[: 2 if len(a) == len(b) else 1]:
        for start in range(1 - len(x), len(y)):
            best = max(best, _plain_ratio(x, y[max(start, 0) : start + len(x)]))
            if best >= enough:
                return enough
    return best


def _plain_token_set(a: str, b: str) -> float:
    mine, theirs = set(a.split()), set(b.split())
    if not mine or not theirs:
        return 0.0
    shared, left, right = (
        " ".join(sorted(x)) for x in (mine & theirs, mine - theirs, theirs - mine)
    )
    if shared and not (left and right):
        return 100.0
    gap = 1 if shared else 0
    sides = [len(shared) + gap + len(x) for x in (left, right)]
    distance = len(left) + len(right) - 2 * _common_length(left, right)
    scores = [100.0 - 100.0 * distance / sum(sides)]
    if shared:
        scores += [
            100.0 - 100.0 * (gap + len(x)) / (len(shared) + side)
            for x, side in zip((left, right), sides)
        ]
    return max(scores)


def _plain_weighted(a: str, b: str, cap: float) -> float:
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    sort_a, sort_b = (" ".join(sorted(x.split())) for x in (a, b))
    if longer < 1.5:
        near = max(_plain_ratio(sort_a, sort_b), _plain_token_set(a, b)) * 0.95
        return min(cap, max(_plain_ratio(a, b), near))
    scale = 0.9 if longer <= 8 else 0.6
    mine, theirs = set(a.split()), set(b.split())
    if mine & theirs:
        by_word = 100.0
    else:
        enough = min(100.0, cap / scale / 0.95)
        by_word = max(
            _plain_partial(sort_a, sort_b, enough),
            _plain_partial(" ".join(sorted(mine)), " ".join(sorted(theirs)), enough),
        )
    score = max(_plain_ratio(a, b), by_word * 0.95 * scale)
    if score < cap:
        score = max(score, _plain_partial(a, b, min(100.0, cap / scale)) * scale)
    return min(cap, score)


def _batched(score: Callable[[str], float], col: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(score, na_action="ignore").astype("float64")

    return F.pandas_udf(run, "double")(col)


class Scorer:
    """The scores of one query text; picks the form that fits the query's length."""

    def __init__(self, query: str):
        self.query = query
        self.fits = len(query) <= WORD_BITS

    def token_set(self, col: Column) -> Column:
        query = self.query
        if self.fits:
            return token_set_ratio(query, col)
        return _batched(lambda text: _plain_token_set(query, text), col)

    def partial(self, col: Column) -> Column:
        query = self.query
        if self.fits:
            return partial_ratio(query, col)
        return _batched(lambda text: _plain_partial(query, text, 100.0), col)

    def weighted(self, col: Column, cap: float = 100.0) -> Column:
        query = self.query
        if self.fits:
            return weighted_ratio(query, col, cap)
        return _batched(lambda text: _plain_weighted(query, text, cap), col)
