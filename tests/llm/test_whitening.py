"""Whitening against numpy's eigenvectors, exact whole numbers and odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from musterroll.llm import whitening


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, n int, x string")


def plain(rows):
    """(distinct whole vectors, components, eigenvalues) by one dense eigenproblem."""
    whole = {tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in rows}
    a = np.array(sorted(whole), dtype=float)
    a -= a.mean(axis=0)
    values, vectors = np.linalg.eigh(a.T @ a / len(a))
    return np.array(sorted(whole)), vectors.T[::-1], values[::-1]


def check(result, rows, components=4):
    whole, vectors, values = plain([v for _, v in rows])
    got = {(r["id"], r["component"]): r for r in result.collect()}
    assert len(got) == len({i for i, _ in rows}) * components
    sums = [int(s) for s in whole.sum(axis=0)]
    n = len(whole)
    for k in range(components):
        sign = 0
        for i, v in rows:
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            r = got[i, k + 1]
            assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            want = (np.array(x) - whole.mean(axis=0)) @ vectors[k] / math.sqrt(values[k])
            sign = sign or np.sign(want * r["whitened"])
            assert r["whitened"] == pytest.approx(sign * want, abs=1e-8)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_against_eigenvectors(spark):
    draw = np.random.default_rng(7)
    rows = [(i, (draw.normal(size=6) * [9, 5, 3, 2, 1, 0.5] + 3).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third of all rows are copies
    data = table(spark, [(i, v, 1, "x") for i, v in rows]).repartition(5)
    check(whitening.whiten(data), rows)


def test_far_mean_and_dependent_columns(spark):
    draw = np.random.default_rng(8)
    free = draw.normal(size=(200, 3)) * [4, 2, 1]
    cells = np.column_stack([free, free[:, 0] + free[:, 1], np.full(200, 7.0)]) + 1e9
    data = table(spark, [(i, v, 1, "x") for i, v in enumerate(cells.tolist())], "double")
    rows = whitening.whiten(data).collect()
    # five columns, three of them free: up to rounding down, the rest hardly varies
    found = sorted({(r["component"], r["explained"]) for r in rows})
    assert [c for c, _ in found[:3]] == [1, 2, 3] and sum(e for _, e in found[:3]) > 0.999
    assert all(r["identity_error"] < 1e-6 for r in rows)
    whole = [[math.floor(256 * c) for c in v] for v in cells.tolist()]
    distinct = {tuple(w) for w in whole}
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    for r in rows:
        exact = sum((n * a - s) ** 2 for a, s in zip(whole[r["id"]], sums, strict=True))
        assert r["deviation"] == exact and r["n"] == n


def test_exact_rank(spark):
    data = table(spark, [(i, [float(i % 7), 2.0 * (i % 7), 5.0], 1, "x") for i in range(30)])
    rows = whitening.whiten(data).collect()
    assert {r["component"] for r in rows} == {1} and rows[0]["explained"] == pytest.approx(1) and rows[0]["n"] == 7


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i % 5)], 1, "x") for i in range(8)]
    odd = [(20, None, 1, "x"), (21, [1.0, None], 1, "x"), (22, [nan, 1.0], 1, "x"), (23, [inf, 1.0], 1, "x"), (24, [1.0], 1, "x"),
           (25, [], 1, "x"), (None, [0.5, -0.5], None, None), (3, [3.0, 4.0], 1, "x")]
    rows = whitening.whiten(table(spark, good + odd)).collect()
    ids = [r["id"] for r in rows]
    assert set(ids) == {*range(8), None} and ids.count(3) == 4 and ids.count(None) == 2
    assert {r["n"] for r in rows} == {9}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1, "x")], [(i, [1.0, 2.0], 1, "x") for i in range(4)], [(1, None, 1, "x")]])
def test_nothing_varies(spark, rows):
    result = whitening.whiten(table(spark, rows))
    assert result.collect() == [] and result.schema["whitened"].dataType == T.DoubleType()


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 40, 0], [0, 3]])
    n, sums = 2, [1 << 40, 3]
    assert whitening.deviations(x, n, sums) == [None, None]
    assert whitening.deviations(np.array([[1 << 20, 0]]), n, [1 << 20, 3]) == [(1 << 40) + 9]


def test_triangular_solve():
    draw = np.random.default_rng(1)
    a, r = draw.normal(size=(20, 5)), np.triu(draw.normal(size=(5, 5))) + 4 * np.eye(5)
    assert np.allclose(whitening.solved(a, r) @ r, a)
