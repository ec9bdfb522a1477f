"""Document scores by masked pseudo-likelihood.

A small window network, written in numpy, predicts a word from the two words on either
side.  Words are numbered by how often the whole corpus has them; a word's number is two
digits, and the network gives the first digit and, knowing it, the second.  The word
itself, among those that share a number, has its share of the number's count.  The sum
over all words of a text of the logarithm of these conditional probabilities is its
pseudo-log-likelihood.

Training goes over all documents in rounds.  In each, every task starts from the same
parameters, masks a share of its words, fits them by gradient steps, and sends its
parameters; the weighted means start the next round.  A word's text and place tell its
round, and over the rounds every word of every document is fitted once.  Word counts and parameters add up
block by block in Spark and have a fixed size, whatever the data.

Edge cases: a text without words (null, empty) has 0 words, sum 0 and no mean; null ids
and repeated rows are scored like any other; an empty table gives an empty result;
contexts end at the ends of a text; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.kernels import U, chunks, mix, word_hashes
from musterroll.llm.shared import added_up

#: Hashed words that are counted, and word numbers: BASE * BASE, the last ones shared.
FEATURE_BITS, BASE, SHARED = 17, 48, 256
#: Words on either side, width of embeddings and of the hidden layer.
SIDE, WIDTH, HIDDEN = 2, 12, 24
ROUNDS, BATCH, RATE = 2, 2048, 0.03
#: Share of the words that a round masks; the rounds share out all of them.
MASKED = 1 / ROUNDS
#: Words scored at a time.
SLICE = 1 << 14
_PAD = BASE * BASE
_BLOCK = 1 << 12


def _hashes(batches):
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            hashes, at = word_hashes(data, offsets, fold_case=True)
            yield batch.slice(lo, hi - lo), (hashes & U((1 << FEATURE_BITS) - 1)).astype(np.int64), at


def _summed(packed: DataFrame, width: int, dtype) -> np.ndarray:
    """Add up arrays that tasks sent in blocks (block, part); the sum has a fixed size."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype) for x in table.column("part").to_pylist())
        return pa.table({"block": table.column("block")[:1], "part": pa.array([total.astype(dtype).tobytes()], pa.binary())})

    out = np.zeros(width, dtype)
    for row in added_up(packed, add, "block int, part binary").toLocalIterator():
        part = np.frombuffer(row["part"], dtype)
        out[row["block"] * _BLOCK : row["block"] * _BLOCK + len(part)] = part
    return out


def _sent(total: np.ndarray) -> pa.RecordBatch:
    parts = [total[i : i + _BLOCK] for i in range(0, len(total), _BLOCK)]
    return pa.record_batch(
        [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
        names=["block", "part"],
    )


def word_counts(rows: DataFrame) -> np.ndarray:
    """How often the corpus has each hashed word."""

    def count(batches):
        total = np.zeros(1 << FEATURE_BITS, np.int64)
        for _, features, _ in _hashes(batches):
            total += np.bincount(features, minlength=len(total))
        yield _sent(total)

    return _summed(rows.mapInArrow(count, "block int, part binary"), 1 << FEATURE_BITS, np.int64)


def numbering(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each hashed word, log share of it in its number, and counts of numbers."""
    order = np.argsort(-counts, kind="stable")
    numbers = np.empty(len(counts), np.int64)
    own = _PAD - SHARED
    numbers[order[:own]] = np.arange(own)
    rest = order[own:]
    numbers[rest] = own + (mix(rest.astype(U)) % U(SHARED)).astype(np.int64)
    smooth = counts + 0.5
    total = np.bincount(numbers, weights=smooth, minlength=_PAD)
    return numbers, np.log(smooth / total[numbers]).astype(np.float32), total


class Network:
    """Two-sided window network; parameters are one flat array in fixed order."""

    def __init__(self, totals: np.ndarray, flat: np.ndarray | None = None):
        share = (totals / totals.sum()).reshape(BASE, BASE)
        self.first = np.log(share.sum(axis=1)).astype(np.float32)
        self.second = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
        shapes = {
            "embed": (_PAD + 1, WIDTH), "inner": (2 * SIDE * WIDTH, HIDDEN), "bias": (HIDDEN,),
            "digit1": (HIDDEN, BASE), "given": (BASE, HIDDEN), "digit2": (HIDDEN, BASE),
        }
        if flat is None:
            rng = np.random.default_rng(4)
            scale = {"embed": 0.3, "inner": 0.3, "bias": 0.0, "digit1": 0.02, "given": 0.1, "digit2": 0.02}
            self.p = {k: (scale[k] * rng.standard_normal(s)).astype(np.float32) for k, s in shapes.items()}
        else:
            self.p, at = {}, 0
            for k, s in shapes.items():
                n = int(np.prod(s))
                self.p[k] = flat[at : at + n].astype(np.float32).reshape(s)
                at += n

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def forward(self, context: np.ndarray, number: np.ndarray):
        p, high = self.p, number // BASE
        x = p["embed"][context].reshape(len(context), -1)
        h = np.tanh(x @ p["inner"] + p["bias"])
        a = _log_softmax(h @ p["digit1"] + self.first)
        g = np.tanh(h + p["given"][high])
        b = _log_softmax(g @ p["digit2"] + self.second[high])
        return x, h, a, g, b

    def log_probability(self, context: np.ndarray, number: np.ndarray) -> np.ndarray:
        _, _, a, _, b = self.forward(context, number)
        rows = np.arange(len(number))
        return a[rows, number // BASE] + b[rows, number % BASE]

    def gradients(self, context: np.ndarray, number: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log probability."""
        p, n = self.p, np.float32(len(number))
        rows, high, low = np.arange(len(number)), number // BASE, number % BASE
        x, h, a, g, b = self.forward(context, number)
        da, db = -np.exp(a) / n, -np.exp(b) / n
        da[rows, high] += 1 / n
        db[rows, low] += 1 / n
        dg = (db @ p["digit2"].T) * (1 - g * g)
        dh = (da @ p["digit1"].T + dg) * (1 - h * h)
        dx = (dh @ p["inner"].T).reshape(-1, WIDTH)
        return {
            "embed": _scatter(context.ravel(), dx, _PAD + 1), "inner": x.T @ dh, "bias": dh.sum(axis=0),
            "digit1": h.T @ da, "given": _scatter(high, dg, BASE), "digit2": g.T @ db,
        }


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def _scatter(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(index, weights=rows[:, k], minlength=size) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def contexts(numbers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers laid out with padding between texts, and each word's place there."""
    n = np.diff(at)
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(numbers)) + SIDE * (text + 1)
    padded = np.full(len(numbers) + SIDE * (len(n) + 1), _PAD, np.int64)
    padded[place] = numbers
    return padded, place


def masked_in(turn: int, features: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which words a round masks, by their text and their place in it."""
    sums = np.concatenate([[0], np.cumsum(features)])
    n = np.diff(at)
    text = np.repeat((sums[at[1:]] - sums[at[:-1]]).astype(U), n)
    place = (np.arange(len(features)) - np.repeat(at[:-1], n)).astype(U)
    draw = (mix(mix(text) + place) >> U(11)) * 2.0**-53
    return np.floor(draw / MASKED) == turn


_OFFSETS = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def train(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Word counts and network parameters, from all documents."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    context = docs.sparkSession.sparkContext
    counts = word_counts(rows)
    flat = Network(numbering(counts)[2]).flat()
    for turn in range(ROUNDS):
        shared = context.broadcast((counts, flat))

        def fit(batches, shared=shared, turn=turn):
            counts, flat = shared.value
            numbers, _, totals = numbering(counts)
            net, seen = Network(totals, flat), 0
            squares = {k: np.full_like(v, 1e-8) for k, v in net.p.items()}
            for _, features, at in _hashes(batches):
                if not len(features):
                    continue
                padded, place = contexts(numbers[features], at)
                masked = place[masked_in(turn, features, at)]
                for lo in range(0, len(masked), BATCH):
                    target = masked[lo : lo + BATCH]
                    grads = net.gradients(padded[target[:, None] + _OFFSETS], padded[target])
                    for k, g in grads.items():
                        squares[k] += g * g
                        net.p[k] += RATE * g / np.sqrt(squares[k])
                seen += len(masked)
            yield _sent(np.append(net.flat().astype(np.float64) * seen, float(seen)))

        total = _summed(rows.mapInArrow(fit, "block int, part binary"), len(flat) + 1, np.float64)
        if total[-1]:
            flat = (total[:-1] / total[-1]).astype(np.float32)
    return counts, flat


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, log_likelihood, mean_log_likelihood) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def judge(batches):
        counts, flat = shared.value
        numbers, inside, totals = numbering(counts)
        net = Network(totals, flat)
        for part, features, at in _hashes(batches):
            padded, place = contexts(numbers[features], at)
            logs = inside[features].astype(np.float64)
            for lo in range(0, len(place), SLICE):
                target = place[lo : lo + SLICE]
                logs[lo : lo + SLICE] += net.log_probability(padded[target[:, None] + _OFFSETS], padded[target])
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            n = np.diff(at)
            total = sums[at[1:]] - sums[at[:-1]]
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(n.astype(np.int64)),
                    pa.array(np.where(n > 0, total, 0.0)),
                    pa.array(total / np.maximum(n, 1), mask=n == 0),
                ],
                names=["id", "n_words", "log_likelihood", "mean_log_likelihood"],
            )

    return rows.mapInArrow(judge, f"id {kind}, n_words long, log_likelihood double, mean_log_likelihood double")


def pseudo_likelihood(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on all documents and score them."""
    return score(docs, train(docs, id, text), id, text)
