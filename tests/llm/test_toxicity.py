"""Segments against their definition, and the model on held-out and planted texts."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from musterroll.llm import toxicity


def by_definition(scores):
    """Maximal scoring segments, found top down: the best one, then left and right of it."""

    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            total = 0
            for b in range(a + 1, hi + 1):
                total += scores[b - 1]
                if total > 0 and (top is None or (total, -(b - a)) > (top[2], -(top[1] - top[0]))):
                    top = (a, b, total)
        return [] if top is None else best(lo, top[0]) + [top] + best(top[1], hi)

    return best(0, len(scores))


@given(st.lists(st.integers(-9, 9), max_size=25))
@settings(max_examples=200, deadline=None)
def test_segments(values):
    # distinct powers of two break ties between segments of equal score
    scores = np.array([v + 2.0 ** -(i + 8) for i, v in enumerate(values)])
    got = toxicity.segments(scores)
    want = by_definition(scores.tolist())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([x for _, _, x in got], [x for _, _, x in want])


def test_log_odds_shrink_rare_features():
    counts = np.zeros((2, 1 << toxicity.FEATURE_BITS))
    counts[:, 0], counts[:, 1], counts[:, 2], counts[:, 3] = (0, 400), (5000, 500), (0, 1), (400, 0)
    counts[0, 4:1000], counts[1, 4:1000] = 90, 10
    odds = toxicity.log_odds(counts)
    assert odds[0] > 2 > 0 > odds[1] and odds[2] < 0 and odds[3] < 0
    assert toxicity.rate_of(np.array([1.0, -1.0]), np.array([0.25, 0.75])) == pytest.approx(np.log(3), abs=1e-6)


def corpus(n=900, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghi") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    bad = ["zzvile", "qqhate", "xxscum", "yyfool"]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randrange(20, 120))]
        toxic = rnd.random() < 0.2
        if toxic:
            at = rnd.randrange(len(text))
            text[at:at] = [rnd.choice(bad) + rnd.choice(["", "ness", "s"]) for _ in range(rnd.randrange(3, 6))]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark, make_docs):
    rows, labels = corpus()
    extra = [(5000, 1, 1), (None, 1, 1), (7, 1, None)]
    frame = spark.createDataFrame(labels + extra, "doc_id long, quality int, toxic int")
    return make_docs(rows), labels, toxicity.train(make_docs(rows), frame)


def test_held_out_rows(trained):
    docs, labels, model = trained
    truth = {d: t for d, _, t in labels}
    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r["id"]).encode()) % 5 == 0]
    assert len(held) > 100
    assert sum(r["predicted"] == truth[r["id"]] for r in held) >= 0.97 * len(held)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in held:
        if truth[r["id"]] and r["passages"]:
            p = r["passages"][0]
            assert any(x in text[r["id"]][p["start"] : p["end"]] for x in ("zzvile", "qqhate", "xxscum", "yyfool"))


def test_same_score_whatever_the_id_and_edges(trained, make_docs):
    _, _, model = trained
    rows = [(1, None), (2, ""), (3, " "), (None, "aa bb"), (4, "zzvile qqhate xxscum yyfool"), (4, "zzvile qqhate xxscum yyfool"), (5, "ab " * 40_000)]
    got = [tuple(r) for r in toxicity.score(make_docs(rows, score="c", predicted="c"), model).collect()]
    assert len(got) == 7 and all(0 <= r[1] <= 1 for r in got)
    scores = {r[0]: r for r in got}
    assert scores[4][2] == 1 and scores[1][1] == scores[2][1] == scores[3][1] < 0.5 and scores[5][2] == 0
    kept = toxicity.without_toxic(make_docs(rows, score="c"), model).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "5", "None"]
    assert kept[0]["score"] == "c"


def test_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(make_docs([(1, "a b")]), none)
    assert not model.trained
    assert [r["predicted"] for r in toxicity.score(make_docs([(1, "a b")]), model).collect()] == [0]
    assert toxicity.without_toxic(make_docs([(1, "a b")]), model).count() == 1
    assert toxicity.score(make_docs([]).where("false"), model).collect() == []


def test_shuffled_labels_join(trained, spark, make_docs, monkeypatch):
    docs, labels, model = trained
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 0)
    again = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert np.array_equal(again.weights, model.weights) and again.slope == pytest.approx(model.slope)


def test_counts_of_few_texts_are_small_at_the_driver(spark, monkeypatch):
    sent, add = [], toxicity.added_up

    def seen(*args):
        out = add(*args)
        sent.extend(len(r["clean"]) + len(r["toxic"]) for r in out.collect())
        return out

    monkeypatch.setattr(toxicity, "added_up", seen)
    rows = spark.createDataFrame([(i % 2, f"some words number{i} " + "bad " * (i % 2)) for i in range(200)], "toxic int, text string")
    counts = toxicity._counts(rows)
    assert sum(sent) < 200_000  # the table has 16 MB
    assert counts.shape == (2, 1 << toxicity.FEATURE_BITS) and counts[0].max() == counts[1].max() == 100
