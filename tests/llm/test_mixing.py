"""The mix against a slot-by-slot schedule and its bound of less than one block."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from musterroll.llm import mixing


@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(1, 30), min_size=1))
@settings(max_examples=80, deadline=None)
def test_period_stays_within_one_block(weights):
    q, done = sum(weights.values()), Counter()
    order = mixing.period(weights)
    for t, s in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[x] - Fraction(t * w, q)) < 1 for x, w in weights.items())
    assert done == weights


def brute(counts, weights, block_rows):
    """Slots one by one, earliest deadline first among released blocks, phase by phase."""
    left = {s: -(-n // block_rows) for s, n in counts.items() if n}
    done, out = Counter(), []
    while left:
        q, here, t = sum(weights[s] for s in left), Counter(), 0
        while all(left.values()):
            free = [s for s in left if here[s] * q // weights[s] <= t]
            s = min(free, key=lambda s: (-(-(here[s] + 1) * q // weights[s]), s))
            out.append((s, done[s]))
            done[s] += 1
            here[s] += 1
            left[s] -= 1
            t += 1
        left = {s: n for s, n in left.items() if n}
    return out


def check(docs, weights=None, block_rows=4, **options):
    rows = mixing.mix(docs, weights, block_rows=block_rows, buckets=8, **options).collect()
    assert sorted(r["position"] for r in rows) == list(range(docs.count()))
    counts = Counter("-" if r["source"] is None else "+" + r["source"] for r in rows)
    chosen = mixing.target_weights(counts) if weights is None else {f"+{s}": w for s, w in weights.items()}
    seen = {r["slot"]: ("-" if r["source"] is None else "+" + r["source"], r["block"]) for r in rows}
    assert [seen[i] for i in sorted(seen)] == brute(counts, chosen, block_rows)
    by_position = [r["slot"] for r in sorted(rows, key=lambda r: r["position"])]
    assert by_position == sorted(by_position)


def test_sample(sample_docs):
    check(sample_docs)


def test_given_weights_and_edges(make_docs):
    docs = make_docs([(i, "t", "abc"[i % 7 % 3]) for i in range(90)] + [(5, None, "a")] * 3, slot="c", b="c", n="c")
    check(docs, {"a": 5, "b": 2, "c": 1, "unused": 3})
    check(make_docs([(1, "x", None), (2, "y", ""), (None, None, "it's\\")]))
    check(make_docs([]).where("false"))


def test_bad_weights(make_docs):
    docs = make_docs([(1, "t", "a")])
    with pytest.raises(ValueError, match="no weight"):
        mixing.mix(docs, {"b": 1})
    with pytest.raises(ValueError, match="whole"):
        mixing.mix(docs, {"a": 0})


def test_schedule_in_pieces_is_the_same(sample_docs, make_docs):
    check(sample_docs, schedule_text=200)
    check(make_docs([(i, "t", "ab c:é"[i % 29 % 6]) for i in range(300)]), schedule_text=1)
    check(make_docs([(1, "x", None), (2, "y", ""), (None, None, "it's\\")]), schedule_text=1)
    check(make_docs([]).where("false"), schedule_text=1)


def test_thousands_of_sources(make_docs):
    rows = [(i, "t", f"s{i % 2600}") for i in range(2600 + 300)] + [(9000 + i, "t", "large") for i in range(900)]
    check(make_docs(rows), block_rows=64)


def test_runs_of_blocks(spark, monkeypatch, sample_docs):
    monkeypatch.setattr(mixing, "SPREAD", 3)
    check(sample_docs, schedule_text=200, block_rows=2)
