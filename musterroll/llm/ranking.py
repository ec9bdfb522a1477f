"""Quality scores by Bradley-Terry ranking of documents.

A document has some twenty measures of its text: lengths, shares of character and word
classes, repetition of words, windows and lines.  Each measure is cut at quantiles of good and
of poor documents; every cut is a step that adds its weight to the document's score.  The
chance that one document is preferred to another is the logistic curve of the difference of their
scores, and the weights are fitted by that loss on pairs of a good and a poor document.

Texts are read once, for the measures, which are written.  Learning rows with the same
steps are put together; the rest is dealt to slots by a hash of the steps, and the good and the
poor ones of a slot meet: some `PAIRS` pairs per row, whatever the number of rows.  Newton's
steps add up gradient and curvature over all pairs in tasks.  A quantile of the learning
rows' scores becomes the threshold, the one that keeps the classes apart best; the score
shown is logistic in the distance to it and passes `KEEP` there.

Edge cases: null and empty texts have every measure zero and are scored so; a document
with several labels counts once for each different one; null labels and labels of
unknown documents are left out; without labels of both kinds every score is 0.5; null ids and
repeated rows are scored like any other; no other column is read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.llm.kernels import LETTER, SPACE, U, chunks, mix, per_text, prefix_hash, span_hash, words
from musterroll.llm.shared import added_up, written

FOLDS = 5
#: Quantiles of each class at which a measure is cut.
QUANTILES = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.98)
#: Pairs per learning row, on average.
PAIRS = 4
RIDGE = 1e-3
STEPS = 25
#: Quantiles of the scores tried as threshold, and the shown score there.
LEVELS = 400
KEEP = 0.3

MEASURES = (
    "words", "characters", "lines", "word_bytes", "words_a_line", "symbols", "marks", "stops", "commas", "digits", "capitals",
    "capital_words", "capital_heads", "letterless", "alone_letters", "repeats", "distinct", "commonest", "windows", "line_copies",
)


def _class(chars: str | bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return out


_SYMBOLS, _MARKS, _STOPS, _COMMAS = _class("#*$%&|<>@^~_=+/\\{}[]"), _class("!?"), _class("."), _class(",;:")
_DIGITS, _UPPER, _LOWER = _class("0123456789"), _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))
_LINE = ~_class("\n")


def _runs(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, size of the largest group, and values found again, per text."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(t)))
    largest = np.zeros(n)
    np.maximum.at(largest, t[at], sizes)
    again = np.bincount(t[at], weights=np.where(sizes > 1, sizes, 0), minlength=n)
    return np.bincount(t[at], minlength=n).astype(float), largest, again


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text, one column per measure."""
    n = len(offsets) - 1
    count = lambda kind: per_text(kind[data].astype(np.int64), offsets).astype(float)
    chars = per_text(((data & 0xC0) != 0x80).astype(np.int64), offsets).astype(float)
    starts, ends, text = words(data, offsets, ~SPACE)
    many = np.bincount(text, minlength=n).astype(float)
    per_word, per_char = np.maximum(many, 1), np.maximum(chars, 1)
    sums = prefix_hash(data, fold_case=True)
    hashes = span_hash(sums, starts, ends) if len(starts) else np.zeros(0, U)

    def inside(kind):  # bytes of a class in each word
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return total[ends] - total[starts]

    letters, upper, lower = inside(LETTER), inside(_UPPER), inside(_LOWER)
    share = lambda flags: np.bincount(text, weights=flags, minlength=n) / per_word
    same = np.zeros(len(text))
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    distinct, largest, _ = _runs(text, hashes, n)
    windows = np.zeros(n)
    if len(hashes) >= 3:
        odd = mix(np.arange(1, 4, dtype=U)) | U(1)
        three = mix(hashes[:-2] * odd[0] + hashes[1:-1] * odd[1] + hashes[2:] * odd[2])
        whole = text[2:] == text[:-2]
        windows = _runs(text[2:][whole], three[whole], n)[2] / np.maximum(many - 2, 1)
    l_starts, l_ends, l_text = words(data, offsets, _LINE)
    lines = np.bincount(l_text, minlength=n).astype(float)
    l_hashes = span_hash(sums, l_starts, l_ends) if len(l_starts) else np.zeros(0, U)
    copies = lines - _runs(l_text, l_hashes, n)[0]
    capitals = count(_UPPER)
    columns = (
        np.log2(1 + many), np.log2(1 + chars), np.log2(1 + lines), share(ends - starts), np.log2(1 + many / np.maximum(lines, 1)),
        count(_SYMBOLS) / per_char, count(_MARKS) / per_word, count(_STOPS) / per_word, count(_COMMAS) / per_word, count(_DIGITS) / per_char,
        capitals / np.maximum(capitals + count(_LOWER), 1), share((upper > 1) & (lower == 0)),
        share(_UPPER[data[starts]] if len(starts) else np.zeros(0)), share(letters == 0), share(ends - starts == 1),
        share(same), distinct / per_word, largest / per_word, windows, copies / np.maximum(lines, 1),
    )
    return np.column_stack(columns)


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, measures) of every document."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1)):
                found = measures(data, offsets)
                at = np.arange(0, found.size + 1, len(MEASURES), dtype=np.int32)
                values = pa.ListArray.from_arrays(pa.array(at), pa.array(found.ravel()))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), values], names=["id", "measures"])

    return rows.mapInArrow(task, f"id {kind}, measures array<double>")


def fold(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % FOLDS


@dataclass
class Ranking:
    """Cuts of every measure, what each step adds up to, threshold; no cuts: untrained."""

    cuts: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    threshold: float = 0.0

    def tables(self) -> list[np.ndarray]:
        """Score of each number of steps, per measure."""
        out, at = [], 0
        for c in self.cuts:
            out.append(np.concatenate([[0.0], np.cumsum(self.weights[at : at + len(c)])]))
            at += len(c)
        return out


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def steps(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """How many cuts each measure is above."""
    return np.column_stack([np.searchsorted(c, values[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8)


def scores(codes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    return sum((t[codes[:, j]] for j, t in enumerate(tables)), np.zeros(len(codes)))


def _codes(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), len(MEASURES))


def _spread(codes: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """One column per cut: 1 where the measure is above it."""
    return np.column_stack([codes[:, [j]] > np.arange(len(c)) for j, c in enumerate(cuts)]).astype(np.float64)


def _cuts(learn: DataFrame) -> list[np.ndarray]:
    """Quantiles of every measure in both classes; a fixed number of values comes back."""
    at = F.array(*map(F.lit, QUANTILES))
    per_class = learn.groupBy("quality").agg(
        *(F.percentile_approx(F.col("measures")[j], at, 2000).alias(m) for j, m in enumerate(MEASURES))
    )
    found = per_class.collect()
    return [np.unique(np.concatenate([r[m] for r in found])) for m in MEASURES] if len(found) == 2 else []


def _pairs(coded: DataFrame, good: int, poor: int) -> DataFrame:
    """(winner, loser, weight): pairs of a good and a poor document, by slots."""
    slots = max(1, round(good * poor / (PAIRS * (good + poor))))
    dealt = coded.withColumn("slot", F.pmod(F.xxhash64("codes"), F.lit(slots)))
    winners = dealt.where("quality = 1").select("slot", F.col("codes").alias("winner"), F.col("n").alias("w"))
    losers = dealt.where("quality = 0").select("slot", F.col("codes").alias("loser"), F.col("n").alias("l"))
    return winners.join(losers, "slot").select("winner", "loser", (F.col("w") * F.col("l")).cast("double").alias("weight"))


def _slopes(pairs: DataFrame, model: Ranking) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Weight of all pairs, their loss, its gradient and curvature."""
    cuts, weights = model.cuts, model.weights
    size, tables = len(weights), model.tables()

    def task(batches):
        total, loss, slope, curve = 0.0, 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                part = batch.slice(lo, 4096)
                won, lost, w = _codes(part.column(0)), _codes(part.column(1)), part.column(2).to_numpy()
                margin = scores(won, tables) - scores(lost, tables)
                p = 1 / (1 + np.exp(np.clip(margin, -500, 500)))  # chance of the wrong order
                differ = _spread(won, cuts) - _spread(lost, cuts)
                total += w.sum()
                loss += (w * np.logaddexp(0, -margin)).sum()
                slope -= (w * p) @ differ
                curve += differ.T @ (differ * (w * p * (1 - p))[:, None])
        packed = np.concatenate([[total, loss], slope, curve.ravel()])
        yield pa.record_batch([pa.array([0], pa.int32()), pa.array([packed.tobytes()], pa.binary())], names=["block", "part"])

    def add(table: pa.Table) -> pa.Table:
        both = sum(np.frombuffer(x.as_py()) for x in table.column("part"))
        return pa.table({"block": table.column("block")[:1], "part": pa.array([np.asarray(both).tobytes()], pa.binary())})

    kind = "block int, part binary"
    found = added_up(pairs.mapInArrow(task, kind), add, kind).collect()  # one row
    both = np.frombuffer(found[0]["part"]) if found else np.zeros(2 + size + size * size)
    return both[0], both[1], both[2 : 2 + size], both[2 + size :].reshape(size, size)


def _newton(pairs: DataFrame, model: Ranking) -> None:
    """Weights of least mean loss with a ridge; steps are halved until the loss falls."""
    at, step = model.weights, np.zeros(len(model.weights))
    best = np.inf
    for _ in range(STEPS):
        model.weights = at + step
        total, loss, slope, curve = _slopes(pairs, model)
        if not total:
            break
        value = loss / total + RIDGE / 2 * float(model.weights @ model.weights)
        if value > best + 1e-12:
            step = step / 2
            if np.abs(step).max() < 1e-6:
                break
            continue
        gained, best, at = best - value, value, model.weights
        if gained < 1e-7:
            break
        step = -np.linalg.solve(curve / total + RIDGE * np.eye(len(at)), slope / total + RIDGE * at)
    model.weights = at


def _threshold(coded: DataFrame, model: Ranking) -> float:
    """The quantile of the learning rows' scores that sets the classes apart best.

    It is found among some hundred quantiles, then among as many between its neighbours.
    """
    tables = model.tables()

    def judge(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(scores(_codes(batch.column(0)), tables)), batch.column(1), batch.column(2)], names=["score", "quality", "n"])

    rows = written(coded.select("codes", "quality", "n").mapInArrow(judge, "score double, quality int, n long"), "ranking-scores")
    levels = F.array(*[F.lit(i / LEVELS) for i in range(LEVELS + 1)])
    inside, ends = F.lit(True), []
    for _ in range(2):  # over all rows, then between the marks beside the best one
        found = rows.where(inside).agg(F.percentile_approx("score", levels, 20 * LEVELS).alias("m")).first()["m"]
        marks = np.unique([*(found or []), *ends])
        above = F.size(F.filter(F.array(*map(F.lit, marks.tolist())), lambda m: m < F.col("score")))
        kept = np.zeros((2, len(marks) + 1))  # rows above so many marks
        for r in rows.groupBy(above.alias("above"), "quality").agg(F.sum("n").alias("n")).collect():  # two per mark
            kept[r["quality"], r["above"]] += r["n"]
        below = kept.cumsum(axis=1) / kept.sum(axis=1, keepdims=True)
        worth = below[0, :-1] - below[1, :-1]  # of a threshold just above each mark
        best = np.flatnonzero(worth >= worth.max() - 1e-12)
        nexts = np.append(marks[1:], marks[-1] + 1)
        widest = int(best[np.argmax(nexts[best] - marks[best])])
        ends = [marks[max(widest - 1, 0)], marks[min(widest + 1, len(marks) - 1)]]
        inside = F.col("score").between(float(ends[0]), float(ends[1]))
    return float((marks[widest] + nexts[widest]) / 2)


def train(texts: DataFrame, labels: DataFrame, id: str = "doc_id") -> Ranking:
    """Fit on all labelled rows outside fold 0; ``texts`` are measured documents."""
    known = labels.select(F.col(id).alias("label_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & (fold(F.col("label_id")) != 0)).distinct()
    learn = written(texts.join(known, F.col("id") == F.col("label_id")).select("quality", "measures"), "ranking-learn")
    cuts = _cuts(learn)
    if not cuts:
        return Ranking()

    def code(batches):
        for batch in batches:
            found = steps(_rows(batch.column(1)), cuts)
            yield pa.record_batch([pa.array([r.tobytes() for r in found], pa.binary()), batch.column(0)], names=["codes", "quality"])

    coded = learn.select("quality", "measures").mapInArrow(code, "codes binary, quality int")
    coded = written(coded.groupBy("codes", "quality").agg(F.count("*").alias("n")), "ranking-codes")
    kinds = {r["quality"]: r["n"] for r in coded.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    model = Ranking(cuts, np.zeros(sum(map(len, cuts))))
    _newton(written(_pairs(coded, kinds[1], kinds[0]), "ranking-pairs"), model)
    model.threshold = _threshold(coded, model)
    return model


def score(texts: DataFrame, model: Ranking) -> DataFrame:
    """(id, score, predicted, rank_score) of measured documents."""
    kind = texts.schema["id"].dataType.simpleString()
    tables = model.tables()
    offset = float(np.log(KEEP / (1 - KEEP)))

    def judge(batches):
        for batch in batches:
            found = scores(steps(_rows(batch.column(1)), model.cuts), tables) if tables else np.zeros(len(batch))
            p = 1 / (1 + np.exp(-np.clip(found - model.threshold + offset, -500, 500))) if tables else np.full(len(batch), 0.5)
            yield pa.record_batch([batch.column(0), pa.array(p), pa.array((p >= KEEP).astype(np.int32)), pa.array(found)], names=["id", "score", "predicted", "rank_score"])

    return texts.mapInArrow(judge, f"id {kind}, score double, predicted int, rank_score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all documents by a ranking learnt from labels outside fold 0."""
    texts = written(measured(docs, id, text), "ranking-measures")
    return score(texts, train(texts, labels, id))
