"""Toxicity by maximum-scoring segments of token log-odds.

A token stands for its word and its leading stems; each is a hashed feature.  The log
odds of a feature between toxic and clean texts get an informative Dirichlet prior (the
feature's share of all labelled texts); what counts is the lower end of the confidence
interval, so rare features weigh nothing.  A linear-time scan finds every maximal
scoring segment of a text.  Under the score distribution of clean text the best of many
segments follows an extreme-value law, which turns a segment's score and the text's
length into an expected number of such segments by chance; a document adds up the
evidence of its segments, and a logistic curve fitted on labelled texts that gave no
counts turns it into a probability.

The model is a table of 2**20 weights and a few numbers, whatever the data.  Counting
adds up per task before anything is shuffled.

Edge cases: null and empty texts have no segments and get the score of no evidence; a
document with several labels counts once per label row; labels of unknown documents and
null labels are left out; without labels of both kinds the model is untrained, every score is
0 and nothing is called toxic; null ids and repeated rows are scored like any other; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.llm.kernels import LETTER, U, chunks, mix, prefix_hash, span_hash, words
from musterroll.llm.shared import added_up, packed, unpacked

FEATURE_BITS = 20
STEMS = (4, 5, 6)
#: The prior's weight as a share of all counts, and the confidence interval's half width.
PRIOR, Z = 0.02, 2.576
#: Every token costs this much, so that clean text scores below zero on average.
DRIFT, CAP = 0.5, 8.0
#: Labels up to so many rows (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_LABELS = 2_000_000
FOLDS, CALIBRATION_FOLD = 5, 4
BLOCK = 1 << 12
SIGNIFICANT = 0.05
#: The share of clean segments that the extreme-value law need not cover.
RARE = 0.01
#: Margins tried in the calibration.
MARGINS = (0, 1, 2, 3, 5)
_BIN = 0.25


@dataclass
class Model:
    """Weights per feature, extreme-value law (rate, log of K) and the logistic curve."""

    weights: np.ndarray = field(repr=False)
    rate: float = 1.0
    log_k: float = 0.0
    margin: float = 0.0
    slope: float = 0.0
    bias: float = 0.0
    trained: bool = False


def fold(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % FOLDS


def _features(data, offsets):
    """Starts, ends and texts of tokens, and one row of features per unit (-1: none)."""
    starts, ends, text = words(data, offsets, LETTER)
    sums = prefix_hash(data, fold_case=True)
    mask = U((1 << FEATURE_BITS) - 1)
    units = [(span_hash(sums, starts, ends) & mask).astype(np.int64)]
    for n in STEMS:
        long = ends - starts > n
        stem = mix(span_hash(sums, starts, np.where(long, starts + n, ends)) + U(n)) & mask
        units.append(np.where(long, stem.astype(np.int64), -1))
    return starts, ends, text, units


def labelled(docs: DataFrame, labels: DataFrame, id: str, text: str, folds: list[int]) -> DataFrame:
    """(text, toxic) of labelled documents in the given folds."""
    known = labels.select(F.col(id).alias("_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & fold(F.col("_id")).isin(folds)
    )
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.join(known, F.col("id") == F.col("_id")).select("toxic", "text")


def _counts(rows: DataFrame) -> np.ndarray:
    """Texts with each feature, clean and toxic: an array of fixed size."""

    def count(batches):
        total = np.zeros((2, 1 << FEATURE_BITS), np.int64)
        for batch in batches:
            toxic = batch.column(0).to_numpy().astype(np.int64)
            for lo, hi, data, offsets in chunks(batch.column(1)):
                _, _, text, units = _features(data, offsets)
                for kind in (0, 1):
                    mine = toxic[lo:hi][text] == kind
                    pairs = [(text[mine] << FEATURE_BITS) + u[mine] for u in units]
                    pairs = [p[u[mine] >= 0] for p, u in zip(pairs, units, strict=True)]
                    seen = np.unique(np.concatenate(pairs)) & ((1 << FEATURE_BITS) - 1)
                    total[kind] += np.bincount(seen, minlength=1 << FEATURE_BITS)
        blocks = total.reshape(2, -1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=(0, 2)))
        yield pa.record_batch(
            [pa.array(used.astype(np.int32)), *(pa.array([packed(blocks[k, b]) for b in used], pa.binary()) for k in (0, 1))],
            names=["block", "clean", "toxic"],
        )

    def add(table: pa.Table) -> pa.Table:
        sums = [sum((unpacked(x, np.int64) for x in table.column(c).to_pylist()), np.zeros(BLOCK, np.int64)) for c in ("clean", "toxic")]
        return pa.table({"block": table.column("block")[:1], "clean": pa.array([packed(sums[0])]), "toxic": pa.array([packed(sums[1])])})

    kind = "block int, clean binary, toxic binary"
    out = np.zeros((2, (1 << FEATURE_BITS) // BLOCK, BLOCK), np.int64)
    # 256 rows of 64 kB at most, far less where few features are seen
    for row in added_up(rows.mapInArrow(count, kind), add, kind).toLocalIterator():
        out[0, row["block"]] = unpacked(row["clean"], np.int64)
        out[1, row["block"]] = unpacked(row["toxic"], np.int64)
    return out.reshape(2, -1)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Lower confidence bound of the log odds of each feature, with a Dirichlet prior."""
    clean, toxic = counts.astype(np.float64)
    prior = np.maximum(PRIOR * (clean + toxic), 1e-9)
    a, b = toxic + prior, clean + prior
    whole = prior.sum()
    delta = np.log(a / (toxic.sum() + whole - a)) - np.log(b / (clean.sum() + whole - b))
    bound = delta - Z * np.sqrt(1 / a + 1 / b)
    return np.where(clean + toxic > 0, np.clip(bound, -1, CAP), -1) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    Only tokens above zero open or extend a candidate, so clean stretches cost nothing.
    """
    after = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before, sum at end, candidate it waits on
    for i in np.flatnonzero(scores > 0).tolist():
        new = [i, i + 1, float(after[i] - scores[i]), float(after[i])]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, r - l) for s, e, l, r, _ in found]


def _scan(batches, weights: np.ndarray):
    """For each chunk: first row, end row, token counts, and segments of each text in bytes."""
    padded = np.append(weights, np.float32(-np.inf))  # feature -1 weighs nothing
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            starts, ends, text, units = _features(data, offsets)
            score = padded[units[0]]
            for u in units[1:]:
                score = np.maximum(score, padded[u])
            n = np.bincount(text, minlength=hi - lo)
            at = np.concatenate([[0], np.cumsum(n)])
            hits: list[list] = [[] for _ in range(hi - lo)]
            for i in np.unique(text[score > 0]).tolist():
                a, b = at[i], at[i + 1]
                hits[i] = [
                    (int(starts[a + s] - offsets[i]), int(ends[a + e - 1] - offsets[i]), x)
                    for s, e, x in segments(score[a:b].astype(np.float64))
                ]
            yield batch.slice(lo, hi - lo), n, hits, score, text


def evidence(rate: float, log_k: float, margin: float, n: int, found: list) -> float:
    """Sum over segments of the log of how rarely chance gives their score, less a margin."""
    least = log_k + np.log(max(n, 1)) + margin
    return min(100.0, sum(max(0.0, rate * x - least) for _, _, x in found))


def rate_of(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * value)) = 1."""
    lo, hi = 0.0, 1.0
    grow = lambda r: float((shares * np.exp(np.minimum(r * values, 500))).sum())
    while grow(hi) < 1 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if grow(mid) < 1 else (lo, mid)
    return hi


def _histogram(rows: DataFrame, of) -> list:
    """Adds up (kind, toxic, bin, n) rows that tasks make of their texts; few bins come back."""
    found = rows.mapInArrow(of, "kind int, toxic int, bin int, n long")
    return found.groupBy("kind", "toxic", "bin").agg(F.sum("n").alias("n")).collect()


def _bins(counts: dict) -> pa.RecordBatch:
    keys = list(counts)
    return pa.record_batch(
        [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)] + [pa.array([int(counts[k]) for k in keys], pa.int64())],
        names=["kind", "toxic", "bin", "n"],
    )


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """Fit the model on labelled rows outside fold 0, all of them."""
    spark = docs.sparkSession
    learn = [f for f in range(1, FOLDS) if f != CALIBRATION_FOLD]
    counts = _counts(labelled(docs, labels, id, text, learn))
    model = Model(log_odds(counts).astype(np.float32))
    if not counts[0].any() or not counts[1].any():
        return model
    shared = spark.sparkContext.broadcast(model.weights)
    held = labelled(docs, labels, id, text, [CALIBRATION_FOLD])

    def scores(batches):
        """Scores of the tokens (kind 0) and of the segments (kind 1) of clean texts."""
        counts: dict = {}
        for part, _, hits, score, token_text in _scan(batches, shared.value):
            toxic = part.column(0).to_numpy()
            clean = score[toxic[token_text] == 0]
            found = np.array([x for i, f in enumerate(hits) if not toxic[i] for _, _, x in f])
            for kind, values, step in ((0, clean, 0.1), (1, found, _BIN)):
                for b, many in zip(*np.unique(np.floor(values / step).astype(int), return_counts=True), strict=True):
                    counts[kind, 0, int(b)] = counts.get((kind, 0, int(b)), 0) + int(many)
        yield _bins(counts)

    rows = _histogram(held, scores)
    if not rows:
        return model
    tokens = [r for r in rows if r["kind"] == 0]
    if not tokens:
        return model
    values = np.array([r["bin"] * 0.1 for r in tokens])
    shares = np.array([r["n"] for r in tokens], float)
    n_tokens = shares.sum()
    # chance always gives some positive token, if a rare one
    values, shares = np.append(values, CAP), np.append(shares / n_tokens, 1e-7)
    model.rate = rate_of(values, shares / shares.sum())
    # K: the least that covers the segments of clean texts but for the rarest, whose
    # tokens (say, of a repeated line) do not come one by one
    best = sorted(((r["bin"] * _BIN, r["n"]) for r in rows if r["kind"] == 1), reverse=True)
    total, above, logs = sum(n for _, n in best), 0, [np.log(1 / n_tokens)]
    for value, many in best:
        above += many
        if above >= RARE * total:
            logs.append(np.log(above / n_tokens) + model.rate * value)
    model.log_k = float(max(logs))
    rate, log_k = model.rate, model.log_k

    def evidences(batches):
        counts: dict = {}
        for part, n, hits, _, _ in _scan(batches, shared.value):
            toxic = part.column(0).to_pylist()
            for i, found in enumerate(hits):
                for m in MARGINS:
                    key = (m, toxic[i], int(np.round(evidence(rate, log_k, m, n[i], found) / _BIN)))
                    counts[key] = counts.get(key, 0) + 1
        yield _bins(counts)

    rows = _histogram(held, evidences)
    if len({r["toxic"] for r in rows}) < 2:
        return model
    best = -np.inf
    for m in MARGINS:  # how much a segment must exceed chance before it counts
        mine = [r for r in rows if r["kind"] == m]
        x, y, w = (np.array([r[k] for r in mine], float) for k in ("bin", "toxic", "n"))
        slope, bias = logistic(x * _BIN, y, w)
        z = slope * x * _BIN + bias
        worth = float((w * (y * z - np.logaddexp(0, z))).sum())
        if worth > best:
            best, model.margin, model.slope, model.bias = worth, float(m), slope, bias
    model.trained = True
    return model


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the likeliest logistic curve, with a slight pull to zero.

    Newton steps, halved until the likelihood grows.
    """

    def worth(a, b):
        z = a * x + b
        return float((w * (y * z - np.logaddexp(0, z))).sum() - 0.25 * a * a - 5e-3 * b * b)

    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g = np.array([(w * (y - p) * x).sum() - 0.5 * a, (w * (y - p)).sum() - 1e-2 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.5, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
        step, scale, now = np.linalg.solve(h, g), 1.0, worth(a, b)
        while scale > 1e-6 and worth(a + scale * step[0], b + scale * step[1]) < now:
            scale /= 2
        a, b = a + scale * step[0], b + scale * step[1]
        if np.abs(scale * step).max() < 1e-7:
            break
    return float(max(a, 0.0)), float(b)


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, predicted, n_tokens, passages) of every document.

    ``passages`` are the significant segments: byte places, score and the number of such
    segments expected by chance in a clean text of that length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def judge(batches):
        m = Model(**shared.value)
        for part, n, hits, _, _ in _scan(batches, m.weights):
            x = np.array([evidence(m.rate, m.log_k, m.margin, n[i], f) for i, f in enumerate(hits)])
            p = 1 / (1 + np.exp(-np.clip(m.slope * x + m.bias, -500, 500))) if m.trained else np.zeros(len(x))
            spans = []
            for i, found in enumerate(hits):
                law = [(s, e, v, float(np.exp(min(m.log_k + np.log(max(n[i], 1)) - m.rate * v, 300)))) for s, e, v in found]
                spans.append([dict(zip(("start", "end", "score", "expected"), z, strict=True)) for z in law if z[3] < SIGNIFICANT])
            yield pa.record_batch(
                [part.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(spans, passage)],
                names=["id", "score", "predicted", "n_tokens", "passages"],
            )

    return rows.mapInArrow(
        judge,
        f"id {kind}, score double, predicted int, n_tokens long, "
        "passages array<struct<start: long, end: long, score: double, expected: double>>",
    )


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(vars(model)), docs.columns.index(text)

    def clean(batches):
        m = Model(**shared.value)
        for batch in batches:
            texts = pa.record_batch([pa.nulls(len(batch)), batch.column(at)], names=["none", "text"])
            keep = []
            for _, n, hits, _, _ in _scan([texts], m.weights):
                x = np.array([evidence(m.rate, m.log_k, m.margin, n[i], f) for i, f in enumerate(hits)])
                keep.append(m.slope * x + m.bias < 0)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return docs.mapInArrow(clean, docs.schema) if model.trained else docs
