"""Leaks: planted passages found, clean texts left alone, subsequences by brute force."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from musterroll.llm import contamination, kernels


@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=20))
@settings(max_examples=200, deadline=None)
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert contamination.common(a, b) == table[-1][-1]


def test_sample_has_every_contained_item(spark, sf_dir, sample_docs):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda s: " " + " ".join(re.findall(r"\w+", (s or "").lower())) + " "
    items = {r["item_id"]: plain(r["text"]) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in sample_docs.collect() for i, t in items.items() if t in plain(r["text"])}
    got = {(r["id"], r["item"]) for r in contamination.leaks(sample_docs, bench).collect()}
    assert want and got == want


def planted(seed=4):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randrange(1, 5))) for _ in range(3000)]
    common = words[:40]
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(n)]
    items = [text(rnd.randrange(12, 70)) for _ in range(30)]
    rows, want = [], set()
    for i in range(300):
        body = text(rnd.randrange(5, 400))
        if i % 3 == 0:
            k = rnd.randrange(30)
            leak = list(items[k])
            if i % 2:  # a paraphrase: a tenth of the words changed, dropped or added
                for _ in range(max(1, len(leak) // 10)):
                    at = rnd.randrange(len(leak))
                    rnd.choice([lambda: leak.__setitem__(at, "other"), lambda: leak.pop(at), lambda: leak.insert(at, "more")])()
            at = rnd.randrange(len(body))
            body[at:at] = leak
            want.add((i, k))
        sep = rnd.choice([" ", ", ", "\n"])
        rows.append((i, sep.join(w.capitalize() if rnd.random() < 0.1 else w for w in body) + "."))
    return rows, [(k, " ".join(x)) for k, x in enumerate(items)], want


def test_planted_passages(spark, make_docs, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 16)  # several blocks
    rows, items, want = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows, item="c", item_share="c")
    got = {(r["id"], r["item"]) for r in contamination.leaks(docs, bench).collect()}
    assert got == want
    kept = {r["doc_id"] for r in contamination.without_leaks(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}


def test_short_items_inside_long_texts(spark, make_docs):
    """Verbatim copies of items of 1 to 15 words are found, whatever their neighbours weigh."""
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(20_000)]
    weights = [1 / (k + 1) for k in range(len(words))]
    text = lambda n: rnd.choices(words, weights, k=n)
    sizes = [1, 2, *(n for n in (3, 4, 5, 6, 7, 9, 12, 15) for _ in range(30))]
    items = [["onlyhere"], ["onlyhere", "too"], *(text(n) for n in sizes[2:])]
    rows = []
    for k, item in enumerate(items):
        body = rnd.choices(words, k=400)  # rarer words than the item's
        at = rnd.randrange(400)
        rows.append((k, " ".join([*body[:at], *item, *body[at:]])))
    rows += [(1000 + i, " ".join(text(300))) for i in range(300)]
    plain = {d: f" {t} " for d, t in rows}
    want = {(d, k) for k, item in enumerate(items) for d, t in plain.items() if f" {' '.join(item)} " in t}
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r["id"], r["item"]) for r in contamination.leaks(make_docs(rows), bench).collect()}
    assert want <= got, sorted(len(items[k]) for _, k in want - got)
    texts = dict(rows)
    for d, k in got - want:  # what else is found has its words in order
        share = contamination.common([hash(w) for w in items[k]], [hash(w) for w in texts[d].split()]) / len(items[k])
        assert share >= (1 if len(items[k]) < contamination.SHORT else contamination.PART)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "one two three four"), (3, "one two three four"), (3, "one two three four"),
            (4, "long " * 30_000 + "alpha beta gamma delta epsilon zeta eta theta iota kappa " + "long " * 100)]
    items = [(1, "one two three four"), (2, ""), (3, None), (4, "Alpha beta gamma delta epsilon. Zeta eta theta iota kappa!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r["id"]), r["item"]) for r in contamination.leaks(make_docs(rows), bench).collect())
    assert got == [("3", 1), ("3", 1), ("4", 4), ("None", 1)]
    assert contamination.leaks(make_docs([]).where("false"), bench).collect() == []
    assert contamination.leaks(make_docs(rows), bench.where("false")).collect() == []
    assert contamination.without_leaks(make_docs(rows), bench.where("false")).count() == 6


def test_directions_are_those_of_the_whole_matrix(make_docs):
    rows, _, _ = planted()
    frame = make_docs(rows).select("doc_id", "text")
    weights = contamination.inverse_frequencies(frame)
    basis = contamination.main_directions(frame, weights)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)
    import pyarrow as pa

    vectors = []
    for _, _, feature, _, at in contamination._tokens(pa.array([t for _, t in rows])):
        heads = contamination._bounds(at, 2 * contamination.STRIDE)
        for a, b in zip(heads, [*heads[1:], len(feature)], strict=True):
            v = np.bincount(feature[a:b], minlength=len(weights)) * weights
            vectors.append(v / np.linalg.norm(v))
    matrix = np.array(vectors)
    best = (np.linalg.svd(matrix, compute_uv=False)[: basis.shape[1]] ** 2).sum()
    assert (np.linalg.norm(matrix @ basis) ** 2) > 0.6 * best


def test_weights_count_each_text_once_and_orders_are_stable(spark, make_docs):
    values = np.random.default_rng(3).integers(0, 1 << 17, 50_000)
    values[::7] = values[0]
    for bits in (17, 40):
        assert (kernels.by_value(values, bits) == np.argsort(values, kind="stable")).all()
    assert len(kernels.by_value(values[:0], 17)) == 0
    texts = ["a b a b a", None, "", "b c", "... !", "a"]
    weights = contamination.inverse_frequencies(make_docs(list(enumerate(texts))).select("doc_id", "text").coalesce(1))
    (_, _, feature, _, at), *_ = contamination._tokens(pa.array(["a", "b", "c", "d"]))
    assert at.tolist() == [0, 1, 2, 3, 4]
    assert np.allclose(weights[feature], np.log(7 / np.array([3, 3, 2, 1])))


def test_texts_come_in_small_pieces_and_candidates_have_an_items_words():
    rows, items, _ = planted()
    column = pa.array([t for _, t in rows] * 4)
    sizes = [sum(len(t) for t in column.slice(lo, hi - lo).to_pylist()) for lo, hi, *_ in contamination._tokens(column)]
    assert len(sizes) > 1 and max(sizes) <= 1 << 18
    every = pa.array([t for _, t in rows])
    weights = np.ones(1 << contamination.FEATURE_BITS, np.float32)
    directions = np.linalg.qr(np.random.default_rng(2).standard_normal((len(weights), 4)))[0]
    queries = contamination.Queries([(k, t, None) for k, t in items], weights, directions)
    seen = 0
    for _, _, feature, _, at in contamination._tokens(every):
        for i, q, a, b, _ in queries.candidates(feature, at):
            size, seen = len(queries.words[q]), seen + 1
            (_, _, own, _, _), *_ = contamination._tokens(pa.array([items[q][1]]))
            least = [contamination._anchors(own, weights, s) for s in (contamination.STRIDE, contamination.SHORT_STRIDE)]
            text = feature[at[i] : at[i + 1]]
            assert size and any(np.isin(text, anchors).sum() >= n for anchors, n in least)
    assert seen


def test_projection_is_the_product_with_all_vectors():
    rows, items, _ = planted(5)
    rnd = np.random.default_rng(6)
    weights = rnd.uniform(0.5, 6, 1 << contamination.FEATURE_BITS).astype(np.float32)
    directions = np.linalg.qr(rnd.standard_normal((len(weights), 4)))[0].astype(np.float32)
    queries = contamination.Queries([(k, t, None) for k, t in items], weights, directions)
    # lists without the words that most items and texts have, which go through one matrix product
    assert len(queries.often) == contamination._OFTEN and len(queries.own) < sum(len(set(t.split())) for _, t in items)
    (_, _, feature, _, at), *_ = contamination._tokens(pa.array([t for _, t in rows[:60]]))
    edges = np.append(contamination._bounds(at, contamination.STRIDE), len(feature))
    strides = np.arange(0, len(edges) - 1, 2)
    own = np.zeros((len(weights), len(items)))
    for k, (_, t) in enumerate(items):
        (_, _, f, _, _), *_ = contamination._tokens(pa.array([t]))
        np.add.at(own[:, k], f, weights[f])
    vectors = np.concatenate([own, directions], axis=1) * weights[:, None]
    want = [vectors[feature[edges[s] : edges[s + 1]]].sum(axis=0) for s in strides]
    assert np.allclose(queries._projected(feature, edges, strides), want, rtol=1e-4, atol=1e-3)
