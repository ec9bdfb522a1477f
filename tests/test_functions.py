import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from musterroll.functions import cleaning as C
from musterroll.functions import periods as P
from musterroll.functions import regions as R
from musterroll.functions import similarity as S


def column(spark, values, expression, dtype="string"):
    """Values of an expression over a column ``c``, in the order given."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, c {dtype}")
    return [r[0] for r in rows.select(expression.alias("x"), "i").orderBy("i").select("x").collect()]


# -- cleaning ------------------------------------------------------------------


def test_whitespace_is_what_python_strips():
    blanks = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(C.WHITESPACE) == set(blanks)


def test_strip_text(spark):
    texts = ["  a b \t", "plain", " ", None, "　x "]
    assert column(spark, texts, C.strip_text(F.col("c"))) == ["a b", "plain", "", None, "x"]
    assert column(spark, texts, C.collapse_spaces(F.col("c"))) == ["a b", "plain", "", None, "x"]


def test_null_tokens(spark):
    got = column(spark, ["", "NULL", "null", "Null", "x", None], C.null_tokens(F.col("c")))
    assert got == [None, None, None, "Null", "x", None]


def test_numbers_are_lenient_value_by_value(spark):
    texts = ["12", " 12.0 ", "12.5", "abc", "nan", "", None, "-7", "1e3", "9" * 40]
    assert column(spark, texts, C.to_long(F.col("c"))) == [
        12, 12, None, None, None, None, None, -7, 1000, None,
    ]
    assert column(spark, texts, C.to_double(F.col("c")))[:9] == [
        12.0, 12.0, 12.5, None, None, None, None, -7.0, 1000.0,
    ]


def test_whole_numbers_are_not_rounded(spark):
    texts = ["12.0000001", "12.0000000000000000000001", "+5", "-0.00", ".0", ".", "1.", "1.5e1", "1e-1", "9007199254740993", "--1", "1_0"]
    assert column(spark, texts, C.to_long(F.col("c"))) == [
        None, None, 5, 0, 0, None, 1, 15, None, 9007199254740993, None, None,
    ]


def test_whole_numbers_print_without_fraction(spark):
    got = column(spark, [94600082111.0, 1.5, None], C.whole_number_text(F.col("c")), "double")
    assert got == ["94600082111", "1.5", None]


def test_dates(spark):
    texts = ["29/03/1994", "1/2/2020", "2024-08-08", "Permanent banning", "31/02/2020", "", None]
    assert column(spark, texts, C.date_to_iso(F.col("c"))) == [
        "1994-03-29", "2020-02-01", "2024-08-08", "Permanent banning", "31/02/2020", "", None,
    ]
    assert column(spark, texts, C.parse_date(F.col("c"))) == [
        dt.date(1994, 3, 29), dt.date(2020, 2, 1), dt.date(2024, 8, 8), None, None, None, None,
    ]


def test_keys_with_and_without_zeros_agree(spark):
    texts = ["000221137", "221137", " 221137 ", "000", "0A1", "", None]
    assert column(spark, texts, C.normalize_key(F.col("c"))) == [
        "221137", "221137", "221137", "0", "0A1", None, None,
    ]


def test_truncate_only_what_is_longer(spark):
    got = column(spark, ["abcde", "abcdef", None], C.truncate_text(F.col("c"), 5, "..."))
    assert got == ["abcde", "abcde...", None]


# -- periods -------------------------------------------------------------------

PERIODS = {
    "2024": "2024", " 2024 ": "2024", "2024-06": "2024-06", "2011-12": "2011-12",
    "2022-23": "2022", "2020-99": "2020", "2020-00": None, "2024-06-30": "2024-06",
    "2024-07-01 00:00:00": "2024-07", "Note": None, "": None, "20245": None, "2024/06/30": None,
}


def test_period_normaliser(spark):
    got = column(spark, PERIODS, P.normalize_period(F.col("c")))
    assert got == list(PERIODS.values())
    assert [P.normalize_period_text(p) for p in PERIODS] == list(PERIODS.values())


@pytest.mark.parametrize(
    "start, end, kept",
    [
        ("2024", None, ["2024", "2024-06", "2025", "note"]),
        ("2024-06", None, ["2024-06", "2025", "note"]),
        (None, "2024", ["2023-24", "2024", "2024-06", "note"]),
        (None, "2024-06", ["2023-24", "2024", "2024-06", "note"]),
        (None, "2024-05-31", ["2023-24", "2024", "note"]),
        ("x", "y", ["2023-24", "2024", "2024-06", "2025", "note"]),
        (None, None, ["2023-24", "2024", "2024-06", "2025", "note"]),
    ],
)
def test_period_range(spark, start, end, kept):
    periods = ["2023-24", "2024", "2024-06", "2025", "note"]
    flags = column(spark, periods, P.period_in_range(F.col("c"), start, end))
    assert [p for p, keep in zip(periods, flags) if keep] == kept
    assert [p for p in periods if P.period_text_in_range(p, start, end)] == kept


def test_null_period_passes(spark):
    assert column(spark, [None, "2024"], P.period_in_range(F.col("c"), "2025", None)) == [True, False]


_SHAPES = st.from_regex(r"\A[0-9]{1,5}(-[0-9]{2}){0,2}( [0-9:]{0,8})?\Z")


@settings(max_examples=15, deadline=None)
@given(st.lists(_SHAPES, min_size=20, max_size=40))
def test_both_period_forms_agree(spark, texts):
    got = column(spark, texts, P.normalize_period(F.col("c")))
    assert got == [P.normalize_period_text(t) for t in texts]


def test_period_arguments():
    assert P.check_period(2024) == "2024"
    assert P.check_period(" 2024-05 ") == "2024-05"
    assert P.check_period(None) is None and P.check_period("  ") is None
    for bad in (True, 1800, 2200, 1.5, [], "May 2024", "24", "2024-05-011"):
        with pytest.raises(ValueError):
            P.check_period(bad)
    with pytest.raises(ValueError, match="before start"):
        P.check_period_range("2025", "2024")


def test_date_bounds():
    assert P.date_bounds("1996", "1997-06") == (dt.date(1996, 1, 1), dt.date(1997, 6, 30))
    assert P.date_bounds("2024-02", "2024-02") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert P.date_bounds(None, 2023) == (None, dt.date(2023, 12, 31))
    with pytest.raises(ValueError):
        P.date_bounds("20240", None)


# -- regions -------------------------------------------------------------------


def test_regions(spark):
    wanted = {
        "NSW": "NSW", " nsw ": "NSW", "New South Wales": "NSW", "au-vic": "VIC", "Tassie": "TAS",
        "2000": "NSW", "2600": "ACT", "2619": "NSW", "0800": "NT", "800": None, "6798": None,
        "wakanda": None, "": None,
    }
    assert column(spark, wanted, R.normalize_region(F.col("c"))) == list(wanted.values())
    assert [R.normalize_region_text(t) for t in wanted] == list(wanted.values())


# -- similarity ----------------------------------------------------------------

WORDS = ["blue", "bolt", "company", "register", "names", "bank", "of", "the", "ééa", "x"]


def texts(n=40, seed=3):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, 8))) for _ in range(n)] + [
        "", "  ", "blue bolt", "bolt blue blue", "abc",
    ]


def subsequence(a, b):
    """Length of the longest common subsequence by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b):
            previous, row[j + 1] = row[j + 1], previous + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def plain_ratio(a, b):
    return 200 * subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def plain_partial(a, b):
    if not a or not b:
        return 0.0
    short, long = sorted((a, b), key=len)
    pairs = [(short, long)] + ([(long, short)] if len(a) == len(b) else [])
    return max(
        plain_ratio(x, y[max(i, 0) : i + len(x)]) for x, y in pairs for i in range(1 - len(x), len(y))
    )


@pytest.mark.parametrize("query", ["blue bolt", "business name register", "bank", "éx"])
def test_scores_against_brute_force(spark, query):
    values = texts()
    c = F.col("c")
    assert column(spark, values, S.ratio(query, c)) == pytest.approx(
        [plain_ratio(query, v) for v in values]
    )
    assert column(spark, values, S.partial_ratio(query, c)) == pytest.approx(
        [plain_partial(query, v) for v in values]
    )
    assert column(spark, values, S.token_set_ratio(query, c)) == pytest.approx(
        [S._plain_token_set(query, v) for v in values]
    )
    for cap in (100.0, 30.0):
        assert column(spark, values, S.weighted_ratio(query, c, cap)) == pytest.approx(
            [S._plain_weighted(query, v, cap) for v in values]
        )


@pytest.mark.parametrize("query", ["blue bolt", "business name register", "bank", "éx", "  ", "x" * 80])
def test_bounds_hold_the_scores(spark, query):
    values = texts()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    for partial in (False, True):
        rows = S.with_bounds(df, query, "c", partial, "b").orderBy("i").collect()
        for r in rows:
            score = S._plain_token_set(query, r["c"])
            score = max(score, plain_partial(query, r["c"])) if partial else score
            assert r["b_low"] - 1e-9 <= score <= r["b_high"] + 1e-9
    assert S.with_bounds(df, query, "c", True, "b").columns == ["i", "c", "b_low", "b_high"]


def test_long_queries_take_the_batch_form(spark):
    query = "of the bank company register names blue bolt of the company x y z"
    scorer = S.Scorer(query)
    assert not scorer.fits
    values = texts(10)
    got = column(spark, values, scorer.partial(F.col("c")))
    assert got == pytest.approx([plain_partial(query, v) for v in values])
    # the plain token score, by its definition
    for v in values:
        mine, theirs = set(query.split()), set(v.split())
        shared = " ".join(sorted(mine & theirs))
        left, right = " ".join(sorted(mine - theirs)), " ".join(sorted(theirs - mine))
        a, b = (f"{shared} {left}".strip(), f"{shared} {right}".strip())
        options = [plain_ratio(shared, a), plain_ratio(shared, b)] if shared else []
        distance = len(left) + len(right) - 2 * subsequence(left, right)
        options.append(100 - 100 * distance / max(1, len(a) + len(b)))
        want = 0.0 if not theirs else (100.0 if shared and not (left and right) else max(options))
        assert S._plain_token_set(query, v) == pytest.approx(want)


def test_scores_by_hand(spark):
    assert column(spark, ["blue bolt large"], S.token_set_ratio("bolt blue", F.col("c"))) == [100.0]
    assert column(spark, ["a blue bolt"], S.partial_ratio("blue", F.col("c"))) == [100.0]
