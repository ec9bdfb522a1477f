"""Embedding whitening by shifted Cholesky QR.

Entries become whole numbers, ``floor(256 * entry)``.  The *fit list* holds each distinct
vector once; its sums are exact.  The centred fit list A is orthogonalised by distributed
passes: every task solves its rows against the triangular factors found so far, adds up
the Gram matrix of what results, and the driver factors the sum.  The first factor is of
a shifted Gram matrix, so it exists however near A is to losing rank; the next passes
bring the columns to orthonormality.  A = Q R3 R2 R1, so the singular values and right
vectors of R = R3 R2 R1 are those of A.

What comes to the driver is a Gram matrix, dimension squared doubles, added up in two steps.

Edge cases: rows whose vector is null, empty or holds null, NaN or infinite entries are
left out; where vectors differ in length, the commonest length among distinct vectors (the
shorter at a tie) is the table's and rows of other lengths are left out; repeated rows and
null ids give their own result rows; directions in which the fit list does not vary have
no component, so one distinct vector or an empty table gives no rows; entries beyond a
64-bit whole number count as its limit; a deviation that does not fit is null; no other
column is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.shared import added_up, written

SCALE = 256
COMPONENTS = 4
PASSES = 3
#: Variance, as a share of the largest, below which a direction counts as constant.
FLAT = 1e-13
SLICE = 4096
_UNIT = np.finfo(np.float64).eps / 2
_LIMIT = 1 << 62


@dataclass
class Whitening:
    """The fit: number of vectors, exact sums, components (rows) by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the usable rows; x is an array of longs."""
    cells = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id).alias("id"), cells.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint")).alias("x"))


def _matrices(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The vectors of a batch, some rows at a time."""
    for lo in range(0, len(column), SLICE):
        part = column.slice(lo, SLICE)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), size)


def _distances(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """x - floor(S / n), exact, and the fraction of S / n that is left to take off.

    Far means are taken off as whole numbers, so centring loses no digits to them.
    """
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    if max(abs(w) for w in whole) >= _LIMIT or x.size and max(abs(int(x.min())), abs(int(x.max()))) >= _LIMIT:
        return x.astype(object) - np.array(whole, dtype=object), rest
    return x - np.array(whole, dtype=np.int64), rest


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    away, rest = _distances(x, n, sums)
    return away.astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S) ** 2, exact; None beyond 64 bits."""
    away, _ = _distances(x, n, sums)
    rest = [s % n for s in sums]
    most = max(abs(int(away.min())), abs(int(away.max()))) if away.size else 0
    if (n * most + n) ** 2 * max(len(sums), 1) < 1 << 63:
        return ((n * away.astype(np.int64) - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - r) ** 2 for c, r in zip(row, rest, strict=True)) for row in away]
    return [v if v < 1 << 63 else None for v in exact]


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q @ upper = rows, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _added_squares(fit: DataFrame, width: int, size: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the fit list of r' r, where ``rows_of`` turns whole vectors into rows r."""
    band = max(1, (1 << 16) // width)  # matrix rows that go together

    def task(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for x in _matrices(batch.column(0), size):
                r = rows_of(x)
                total += r.T @ r
        parts = [total[i : i + band].tobytes() for i in range(0, width, band)]
        yield pa.record_batch([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary())], names=["block", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in table.column("part"))
        return pa.table({"block": table.column("block")[:1], "part": pa.array([np.asarray(total).tobytes()], pa.binary())})

    kind = "block int, part binary"
    out = np.zeros((width, width))
    for row in added_up(fit.mapInArrow(task, kind), add, kind).toLocalIterator():
        lo = row["block"] * band
        out[lo : lo + band] = np.frombuffer(row["part"]).reshape(-1, width)
    return out


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of the Gram matrix; the shift grows where rounding hides a pivot."""
    least = 64 * _UNIT * (np.linalg.norm(gram, 2) or 1.0)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, least)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension, as decimals."""

    def task(batches):
        n, low, high = 0, [0] * size, [0] * size
        for batch in batches:
            for x in _matrices(batch.column(0), size):  # halves of 32 bits cannot overflow
                n += len(x)
                low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
                high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0), strict=True)]
        yield pa.record_batch(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array([n] * size, pa.int64()), pa.array(low, pa.decimal128(38)), pa.array(high, pa.decimal128(38))],
            names=["dim", "n", "low", "high"],
        )

    parts = fit.mapInArrow(task, "dim int, n long, low decimal(38,0), high decimal(38,0)")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")).toLocalIterator()
    found = {r["dim"]: (r["n"], (int(r["high"]) << 32) + int(r["low"])) for r in rows}
    return (found[0][0], [found[i][1] for i in range(size)]) if found else (0, [0] * size)


def fit(whole: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The fit list, written once, and the whitening fitted on all of it."""
    fit_list = written(whole.select("x").distinct(), "whitening-fit")
    sizes = fit_list.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return fit_list, None
    size = sizes[0]["size"]
    fit_list = fit_list.where(F.size("x") == size)
    n, sums = _sums(fit_list, size)
    factors: list[np.ndarray] = []
    trace = 0.0
    for k in range(PASSES):
        known = list(factors)

        def rows_of(x, known=known):
            rows = centred(x, n, sums)
            for upper in known:
                rows = solved(rows, upper)
            return rows

        gram = _added_squares(fit_list, size, size, rows_of)
        if k == 0:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                return fit_list, Whitening(n, sums, np.zeros((0, size)), np.zeros(0), 0.0)
        bound = 11 * (float(n) * size + size * (size + 1)) * _UNIT * np.linalg.norm(gram, 2)
        factors.append(cholesky(gram, bound if k == 0 else 0.0))
    r = np.eye(size)
    for upper in factors:
        r = upper @ r
    _, values, right = np.linalg.svd(r)
    eigen = values**2 / n
    keep = int((eigen[:components] > FLAT * eigen[0]).sum())
    right = right[:keep]
    signs = np.sign(right[np.arange(keep), np.abs(right).argmax(axis=1)])
    return fit_list, Whitening(n, sums, right * signs[:, None], eigen[:keep], trace)


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width, size = len(model.components) + 1, len(model.sums)

    def rows_of(x):
        return np.column_stack([projected(x, model), np.ones(len(x))])

    squares = _added_squares(fit_list, width, size, rows_of) / model.n
    mean = squares[-1, :-1]
    return float(np.abs(squares[:-1, :-1] - np.outer(mean, mean) - np.eye(width - 1)).max())


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per component."""
    whole = whole_vectors(vectors, id, vector)
    kind = whole.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit_list, model = fit(whole, components)
    if model is None or not len(model.components):
        return vectors.sparkSession.createDataFrame([], schema)
    error, size, many = identity_error(fit_list, model), len(model.sums), len(model.components)
    shares = model.eigenvalues / model.trace

    def task(batches):
        for batch in batches:
            for k, x in enumerate(_matrices(batch.column(1), size)):
                ids = batch.column(0).slice(k * SLICE, SLICE).take(pa.array(np.repeat(np.arange(len(x)), many)))
                far = np.repeat(np.array(deviations(x, model.n, model.sums), dtype=object), many)
                yield pa.record_batch(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(ids), model.n)),
                        pa.array(far.tolist(), pa.int64()),
                        pa.array(projected(x, model).ravel()),
                        pa.array(np.tile(shares, len(x))),
                        pa.array(np.full(len(ids), error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whole.where(F.size("x") == size).mapInArrow(task, schema)
