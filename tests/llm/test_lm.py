"""The network against finite differences, and its scores against a plain sum."""

import random

import numpy as np
import pytest

from musterroll.llm import lm


def small_network():
    rng = np.random.default_rng(0)
    net = lm.Network(rng.random(lm._PAD) + 0.1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    return net, rng


def test_gradients_match_finite_differences():
    net, rng = small_network()
    context, number = rng.integers(0, lm._PAD + 1, (40, 2 * lm.SIDE)), rng.integers(0, lm._PAD, 40)
    grads = net.gradients(context, number)
    for name, x in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in x.shape)
            if name == "embed":
                at = (int(context[0, 0]), at[1])
            old, values = x[at], []
            for step in (1e-5, -1e-5):
                x[at] = old + step
                values.append(net.log_probability(context, number).mean())
            x[at] = old
            assert abs((values[0] - values[1]) / 2e-5 - grads[name][at]) < 1e-6


def test_probabilities_sum_to_one():
    net, rng = small_network()
    context = np.repeat(rng.integers(0, lm._PAD + 1, (1, 2 * lm.SIDE)), lm._PAD, axis=0)
    assert abs(np.exp(net.log_probability(context, np.arange(lm._PAD))).sum() - 1) < 1e-5
    counts = rng.integers(0, 50, 1 << lm.FEATURE_BITS)
    numbers, inside, _ = lm.numbering(counts)
    assert np.allclose(np.bincount(numbers, weights=np.exp(inside), minlength=lm._PAD), 1, atol=1e-3)


def test_contexts_end_with_the_text():
    padded, place = lm.contexts(np.array([1, 2, 3, 9]), np.array([0, 3, 3, 4]))
    pad = lm._PAD
    assert padded[place[:, None] + lm._OFFSETS].tolist() == [
        [pad, pad, 2, 3], [pad, 1, 3, pad], [1, 2, pad, pad], [pad] * 4,
    ]


def test_every_word_is_fitted_once():
    """Over the rounds, with production values, and however texts are cut into chunks."""
    rng = np.random.default_rng(6)
    n = np.array([0, 1, 700, 0, 3, 900])
    at, features = np.concatenate([[0], np.cumsum(n)]), rng.integers(0, 1 << lm.FEATURE_BITS, n.sum())
    rounds = np.array([lm.masked_in(t, features, at) for t in range(lm.ROUNDS)])
    assert (rounds.sum(axis=0) == 1).all()
    assert (rounds.mean(axis=1) > 0.4).all()
    alone = [lm.masked_in(0, features[a:b], np.array([0, b - a])) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert (np.concatenate(alone) == rounds[0]).all()


def test_training_fits_all_words(make_docs, monkeypatch):
    sums, plain = [], lm._summed
    monkeypatch.setattr(lm, "_summed", lambda *a: sums.append(plain(*a)) or sums[-1])
    rnd = random.Random(3)
    lm.train(make_docs([(i, " ".join(rnd.choices("abcdef", k=i % 40))) for i in range(200)]))
    counts, *rounds = sums
    assert counts.sum() == sum(i % 40 for i in range(200)) == sum(r[-1] for r in rounds)


def test_learns_order_and_scores_every_row(make_docs, monkeypatch):
    monkeypatch.setattr(lm, "MASKED", 0.5)
    monkeypatch.setattr(lm, "BATCH", 256)
    rnd = random.Random(2)
    follow = {a: rnd.sample("abcdefghijkl", 2) for a in "abcdefghijkl"}

    def chain(n):
        out = [rnd.choice("abcdefghijkl")]
        while len(out) < n:
            out.append(rnd.choice(follow[out[-1]]))
        return out

    rows = [(i, " ".join(chain(60))) for i in range(600)]
    held = [chain(60) for _ in range(40)]
    mixed = [rnd.sample(x, len(x)) for x in held]
    model = lm.train(make_docs(rows))
    docs = make_docs([(i, " ".join(x)) for i, x in enumerate(held + mixed)] + [(90, None), (91, ""), (None, "a"), (92, "b c"), (92, "b c")], n_words="c")
    got = {}
    for r in lm.score(docs, model).collect():
        got.setdefault(r["id"], []).append(r)
    assert sum(got[i][0]["mean_log_likelihood"] > got[i + 40][0]["mean_log_likelihood"] for i in range(40)) >= 38
    for i in (90, 91):
        assert tuple(got[i][0])[1:] == (0, 0.0, None)
    assert got[92][0]["log_likelihood"] == pytest.approx(got[92][1]["log_likelihood"], rel=1e-5)
    assert got[None][0]["n_words"] == 1
    # a plain sum over the words of one text
    from musterroll.llm.kernels import buffers, word_hashes
    import pyarrow as pa

    counts, flat = model
    numbers, inside, totals = lm.numbering(counts)
    net = lm.Network(totals, flat)
    hashes, at = word_hashes(*buffers(pa.array([" ".join(held[0])])), fold_case=True)
    f = (hashes & np.uint64((1 << lm.FEATURE_BITS) - 1)).astype(int)
    words, total = [lm._PAD] * 2 + [int(numbers[x]) for x in f] + [lm._PAD] * 2, 0.0
    for i, x in enumerate(f):
        c = words[i : i + 2] + words[i + 3 : i + 5]
        total += float(net.log_probability(np.array([c]), np.array([words[i + 2]]))[0]) + float(inside[x])
    assert total == pytest.approx(got[0][0]["log_likelihood"], rel=1e-4)


def test_empty_table(make_docs):
    assert lm.pseudo_likelihood(make_docs([]).where("false")).collect() == []
