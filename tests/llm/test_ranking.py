"""Pairwise ranking: measures by plain Python, loss by numbers, held-out labels, odd input."""

import numpy as np
import pyarrow as pa
import pytest

from musterroll.llm import ranking
from musterroll.llm.kernels import buffers

TEXTS = ["", "One two, two three.\nOne two, two three.\n\nEND!!", "a | b | c", "Ünder é 12 $$ x x x", " \n ", "w " * 4000]


def plain(text):
    words, lines = text.split(), [x for x in text.split("\n") if x]
    folded = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    flines = ["".join(c.lower() if c.isascii() else c for c in x) for x in lines]
    n, chars = max(len(words), 1), max(len(text), 1)
    three = [tuple(folded[i : i + 3]) for i in range(len(words) - 2)]
    count = lambda kind: sum(c in kind for c in text)
    up, low = [c for c in text if c.isascii() and c.isupper()], [c for c in text if c.isascii() and c.islower()]
    return {
        "words": np.log2(1 + len(words)), "characters": np.log2(1 + len(text)), "lines": np.log2(1 + len(lines)),
        "word_bytes": sum(len(w.encode()) for w in words) / n, "symbols": count("#*$%&|<>@^~_=+/\\{}[]") / chars, "marks": count("!?") / n,
        "stops": count(".") / n, "commas": count(",;:") / n, "digits": count("0123456789") / chars,
        "capitals": len(up) / max(len(up) + len(low), 1),
        "letterless": sum(not any(c.isalnum() or ord(c) > 127 for c in w) for w in words) / n,
        "repeats": sum(a == b for a, b in zip(folded, folded[1:], strict=False)) / n, "distinct": len(set(folded)) / n,
        "commonest": max((folded.count(w) for w in set(folded)), default=0) / n,
        "windows": sum(three.count(t) > 1 for t in three) / max(len(words) - 2, 1) if len(three) < 500 else 1.0,
        "line_copies": (len(flines) - len(set(flines))) / max(len(flines), 1),
    }


def test_measures():
    data, offsets = buffers(pa.array(TEXTS))
    found = ranking.measures(data, offsets)
    for i, text in enumerate(TEXTS):
        for name, value in plain(text).items():
            assert found[i, ranking.MEASURES.index(name)] == pytest.approx(value), (i, name)
    alone = np.concatenate([ranking.measures(*buffers(pa.array([t]))) for t in TEXTS])
    assert np.allclose(alone, found)


def test_slopes_against_differences(spark):
    draw = np.random.default_rng(3)
    cuts = [np.arange(3.0)] * len(ranking.MEASURES)
    model = ranking.Ranking(cuts, draw.normal(size=3 * len(cuts)) / 5)
    codes = draw.integers(0, 4, (40, len(cuts))).astype(np.uint8)
    pairs = [(bytearray(codes[i].tobytes()), bytearray(codes[39 - i].tobytes()), float(i % 3 + 1)) for i in range(20)]
    table = spark.createDataFrame(pairs, "winner binary, loser binary, weight double").repartition(3)

    def loss(weights):
        tables = ranking.Ranking(cuts, weights).tables()
        s = ranking.scores(codes, tables)
        return sum(w * np.log1p(np.exp(-(s[i] - s[39 - i]))) for i, (_, _, w) in enumerate(pairs))

    total, value, slope, curve = ranking._slopes(table, model)
    assert total == sum(w for _, _, w in pairs) and value == pytest.approx(loss(model.weights))
    for j in range(0, len(model.weights), 7):
        step = np.eye(len(model.weights))[j] * 1e-4
        up, down = loss(model.weights + step), loss(model.weights - step)
        assert slope[j] == pytest.approx((up - down) / 2e-4, abs=1e-5)
        assert curve[j, j] == pytest.approx((up + down - 2 * value) / 1e-8, abs=1e-3)


def test_held_out_labels(spark, sample_docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learnt = ranking.quality_scores(sample_docs, labels)
    again = ranking.quality_scores(sample_docs.repartition(7), labels.repartition(3))
    rows = {r["id"]: r for r in learnt.collect()}
    assert len(rows) == sample_docs.count()
    assert all(r["predicted"] == (r["score"] >= ranking.KEEP) for r in rows.values())
    for r in again.collect():
        assert r["score"] == pytest.approx(rows[r["id"]]["score"], abs=1e-6)
    held = labels.where(ranking.fold(labels["doc_id"]) == 0).collect()
    assert held and np.mean([rows[r["doc_id"]]["predicted"] == r["quality"] for r in held]) >= 0.9


def test_labels_of_fold_zero_are_not_read(spark, sample_docs, sf_dir):
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("quality", F.when(ranking.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["id"]: r["score"] for r in ranking.quality_scores(sample_docs, labels).collect()}
    b = {r["id"]: r["score"] for r in ranking.quality_scores(sample_docs, turned).collect()}
    assert a.keys() == b.keys() and all(b[i] == pytest.approx(v, abs=1e-9) for i, v in a.items())


def test_odd_input(spark, make_docs):
    good, poor = "The cat sat. It was, they said, a calm day{}.", "BUY!! $$$ BUY!! {} !!"
    rows = [(i, (good if i % 3 else poor).format(" so" * (i % 5))) for i in range(60)]
    rows += [(None, None), (100, ""), (101, None), (1, good), (102, "x " * 200_000)]
    rows += [(200, poor.format("x"))] * 30  # a third of the rows are copies
    docs = make_docs(rows, id="i", quality="q", measures="m")
    labels = [(i, int(i % 3 > 0)) for i in range(60)] + [(7, None), (8, 5), (None, 1), (999, 0), (2, 1), (200, 0)]
    labels = spark.createDataFrame([(i, q, "c") for i, q in labels], "doc_id bigint, quality int, codes string")
    found = ranking.quality_scores(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["predicted"] for r in found if r["id"] == 200} == {0}
    assert all(r["predicted"] == int(r["id"] % 3 > 0) for r in found if r["id"] is not None and r["id"] < 60)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None)]])
def test_untrained(spark, make_docs, labels):
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = ranking.quality_scores(make_docs([(1, "a"), (2, "b")]), labels).collect()
    assert [(r["score"], r["predicted"]) for r in found] == [(0.5, 1)] * 2
    assert ranking.quality_scores(make_docs([(1, "a")]).limit(0), labels).collect() == []
