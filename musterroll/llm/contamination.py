"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of words with TF-IDF weights over hashed words.  A randomised
singular value decomposition finds the corpus's main directions: every task multiplies
its passages with a random matrix and back, the products add up in Spark, and a QR step
gives a basis.  The latent space is that basis together with the benchmark's own passages.
Passages whose cosine with an item is high enough there are candidates; they are then
compared word by word: the longest common subsequence with the whole item, and with its
answer (its last sentence, unless a column names it), decide.  A match needs so many of an
item's words in one passage; passages with fewer of every item are not projected, and for
items of under two short strides that count decides in place of the cosine.

Benchmark items are the queries; they are worked in blocks of fixed number, so what is
sent to tasks is bounded: a block's texts and weights, and 16 directions of 2**17 rows.

Edge cases: null and empty texts and items never match; an item shorter than
``SHORT`` words must be found whole; null ids, repeated rows and repeated items are
treated like any other; an empty benchmark gives no matches; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Set

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.kernels import LETTER, U, by_value, chunks, prefix_hash, span_hash, spans
from musterroll.llm.shared import added_up, written

FEATURE_BITS, DIRECTIONS = 17, 16
#: A passage is two strides of words, so a match of a stride lies whole in some passage.
#: Items of fewer words than the first stride are sought in passages of the second kind.
STRIDE, SHORT_STRIDE = 32, 8
#: Items per block of queries.
BLOCK_ITEMS = 256
#: Candidates: cosine in the latent space.
LEAST_COSINE = 0.45
#: Matches: share of the item's words in order, or fewer with nearly all of its answer.
WHOLE, PART, ANSWER = 0.75, 0.55, 0.8
SHORT = 8
_SEED = 20
#: Strides whose words are counted at a time.
_SLICE = 1 << 11
#: Bytes of texts worked on at a time, so that the arrays of a step stay in a core's cache.
_PIECE = 1 << 17
#: Words that many items have and texts often use: counted per stride, for one matrix product.
_OFTEN = 32


def _tokens(column: pa.Array) -> Iterator[tuple]:
    """For each chunk: first and end row, features, word hashes and word offsets per text."""
    for lo, hi, data, offsets in chunks(column, _PIECE):
        starts, ends = spans(data, offsets, LETTER)
        hashes = span_hash(prefix_hash(data, fold_case=True), starts, ends) if len(starts) else np.zeros(0, U)
        at = np.searchsorted(starts, offsets)
        yield lo, hi, (hashes & U((1 << FEATURE_BITS) - 1)).astype(np.int64), hashes, at


def _bounds(at: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs of ``size`` words, none across texts."""
    n = np.diff(at)
    pieces = -(-n // size)
    text = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return at[:-1][text] + number * size


def _added(rows: DataFrame, of, width: int) -> np.ndarray:
    """Sum of one float array per task: blocks are added in Spark, the sum is returned."""
    block = 1 << 13

    def emit(batches):
        total = of(batches).ravel()
        parts = [total[i : i + block] for i in range(0, width, block)]
        yield pa.record_batch(
            [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())],
            names=["block", "part"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table.column("part").to_pylist())
        return pa.table({"block": table.column("block")[:1], "part": pa.array([total.astype(np.float32).tobytes()])})

    out = np.zeros(width, np.float32)
    schema = "block int, part binary"
    for row in added_up(rows.mapInArrow(emit, schema), add, schema).toLocalIterator():
        part = np.frombuffer(row["part"], np.float32)
        out[row["block"] * block : row["block"] * block + len(part)] = part
    return out


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """Logarithm of how rarely a text has each feature, over all texts."""
    size = 1 << FEATURE_BITS

    def count(batches):
        total = np.zeros(size + 1)
        for batch in batches:
            for lo, hi, feature, _, at in _tokens(batch.column(1)):
                order = by_value(feature, FEATURE_BITS)
                text, feature = np.repeat(np.arange(hi - lo), np.diff(at))[order], feature[order]
                new = np.ones(len(order), bool)  # a text's words of one feature stand together
                new[1:] = (feature[1:] != feature[:-1]) | (text[1:] != text[:-1])
                total[:size] += np.bincount(feature[new], minlength=size)
                total[size] += hi - lo
        return total

    found = _added(rows, count, size + 1)
    return np.log((1 + found[size]) / (1 + found[:size])).astype(np.float32)


def main_directions(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Orthonormal basis of the passages' main directions (features x DIRECTIONS)."""
    size = 1 << FEATURE_BITS
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def multiply(batches):
        idf = shared.value
        random = np.random.default_rng(_SEED).standard_normal((size, DIRECTIONS), np.float32)
        random *= idf[:, None]
        total = np.zeros((size, DIRECTIONS), np.float32)
        for batch in batches:
            for _, _, feature, _, at in _tokens(batch.column(1)):
                if not len(feature):
                    continue
                heads = _bounds(at, 2 * STRIDE)
                lengths = np.diff(np.append(heads, len(feature)))
                w = idf[feature]
                norm = np.sqrt(np.add.reduceat(w * w, heads)) + 1e-6
                y = np.add.reduceat(np.take(random, feature, axis=0), heads, axis=0) / (norm**2)[:, None]
                order = by_value(feature, FEATURE_BITS)
                in_order = feature[order]
                first = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
                words = np.take(y, np.repeat(np.arange(len(heads)), lengths)[order], axis=0)
                words *= w[order, None]
                total[in_order[first]] += np.add.reduceat(words, first, axis=0)
        return total

    found = _added(rows, multiply, size * DIRECTIONS).reshape(size, DIRECTIONS)
    basis, _ = np.linalg.qr(found.astype(np.float64))
    return basis.astype(np.float32)


def _window(size: int) -> int:
    """Words of a text in which a match of an item of ``size`` words lies."""
    return max(size * 3 // 2, size + 4)


def _anchors(features: np.ndarray, weights: np.ndarray, stride: int) -> tuple[np.ndarray, int]:
    """An item's rarer features, and how many words with them some passage of a match has.

    A match has ``need`` of the item's words in a window; without its ``spare`` most
    frequent ones, need - spare are left.  The window's strides make up ``passages``
    passages, one of which has its part of them.
    """
    size = len(features)
    need = size if size < SHORT else int(np.ceil(PART * size - 1e-9))
    spare = need // 2 if size >= 2 * SHORT_STRIDE else 0
    rarest = features[np.argsort(-weights[features], kind="stable")[: size - spare]]
    strides = (_window(size) - 2) // stride + 2
    passages = -(-strides // 2)
    return np.unique(rarest), -(-(need - spare) // passages)


def _entries(feature: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a list by feature that words have: run of the word, entry."""
    n = first[feature + 1] - first[feature]
    ends = np.cumsum(n)
    entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[feature] - (ends - n), n)
    return np.repeat(np.repeat(np.arange(len(lengths)), lengths), n), entry


class Queries:
    """A block of benchmark items: word hashes, answers, and the latent space with them.

    Tasks get its plain arrays and lists, and need no copy of this class.
    """

    @classmethod
    def of(cls, state: dict) -> Queries:
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def __init__(self, items: list[tuple], weights: np.ndarray, directions: np.ndarray):
        self.ids, self.words, self.known, self.answers, found = [], [], [], [], []
        for item, text, answer in items:
            column = pa.array([text or "", answer if answer is not None else last_sentence(text or "")])
            (_, _, feature, hashes, at), *_ = _tokens(column)
            if at[1] == 0:
                continue
            self.ids.append(item)
            self.words.append(hashes[: at[1]].tolist())
            self.known.append(frozenset(self.words[-1]))
            self.answers.append(hashes[at[1] :].tolist())
            found.append(feature[: at[1]])
        short = np.array([len(w) < STRIDE for w in self.words], bool)
        kinds = ((STRIDE, np.arange(len(found))), (SHORT_STRIDE, np.flatnonzero(short)))
        self.scales = []
        for stride, items in kinds:
            if not len(items):
                continue
            anchors = [_anchors(found[k], weights, stride) for k in items]
            flat = np.concatenate([a for a, _ in anchors])
            order = np.argsort(flat, kind="stable")
            first = np.searchsorted(flat[order], np.arange((1 << FEATURE_BITS) + 1)).astype(np.int32)
            holders = np.repeat(np.arange(len(items)), [len(a) for a, _ in anchors])[order]
            least = np.array([n for _, n in anchors])
            counted = np.array([stride == SHORT_STRIDE and len(found[k]) < 2 * SHORT_STRIDE for k in items])
            self.scales.append((stride, items, first, holders, least, counted))
        # The items' weights on the features they have; with the directions they span the
        # latent space.  Both are kept times the weight that a passage's word has.
        used = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        own = np.zeros((len(used), len(found)))
        for k, features in enumerate(found):
            np.add.at(own[:, k], np.searchsorted(used, features), weights[features])
        load = np.count_nonzero(own, axis=1) * np.exp(-weights[used])
        often = np.argsort(-load, kind="stable")[:_OFTEN]
        self.often = own[often] * weights[used[often], None]
        self.slot = np.full(1 << FEATURE_BITS, len(often), np.int32)
        self.slot[used[often]] = np.arange(len(often))
        seldom = np.ones(len(used), bool)
        seldom[often] = False
        rows, self.holders = np.nonzero(own * seldom[:, None])
        self.own = own[rows, self.holders] * weights[used[rows]]
        self.first = np.searchsorted(used[rows], np.arange((1 << FEATURE_BITS) + 1)).astype(np.int32)
        self.directions = directions * weights[:, None]
        # products of the spanning vectors; their Cholesky factor makes them orthonormal
        cross = own.T @ directions[used]
        products = np.block([[own.T @ own, cross], [cross.T, directions.T @ directions]])
        ridge = 1e-6 * max(np.trace(products) / max(len(products), 1), 1e-9)
        factor = np.linalg.cholesky(products + ridge * np.eye(len(products)))
        self.to_latent = np.linalg.inv(factor).T.astype(np.float32)
        latent = products[: len(found)].astype(np.float32) @ self.to_latent
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def candidates(self, feature: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, item, first word, end word, cosine) of passages near an item; runs merge."""
        if not len(feature):
            return []
        return [x for scale in self.scales for x in self._near(feature, at, *scale)]

    def _crowded(self, feature, edges, follows, first, holders, least) -> Iterator[tuple]:
        """Passages with enough anchors of some item, and which items those are."""
        size = len(least)
        for lo in range(0, len(follows), _SLICE):
            hi = min(lo + _SLICE + 1, len(follows))  # and the stride after the last passage
            stride, entry = _entries(feature[edges[lo] : edges[hi]], np.diff(edges[lo : hi + 1]), first)
            counts = np.bincount(stride * size + holders[entry], minlength=(hi - lo) * size).reshape(hi - lo, size)
            counts[:-1] += counts[1:] * follows[lo : hi - 1, None]
            enough = counts[:_SLICE] >= least
            near = np.flatnonzero(enough.any(axis=1))
            if len(near):
                yield lo + near, enough[near]

    def _projected(self, feature, edges, strides) -> np.ndarray:
        """Products of the words of each stride with the vectors that span the latent space."""
        n, size = edges[strides + 1] - edges[strides], len(self.ids)
        flat = feature[np.arange(n.sum()) + np.repeat(edges[strides] - (np.cumsum(n) - n), n)]
        stride, entry = _entries(flat, n, self.first)
        mine = np.bincount(stride * size + self.holders[entry], weights=self.own[entry], minlength=len(strides) * size)
        slots = len(self.often) + 1  # the last one is for all other words
        often = np.bincount(np.repeat(np.arange(len(strides)) * slots, n) + self.slot[flat], minlength=len(strides) * slots)
        mine = mine.reshape(-1, size) + often.reshape(-1, slots)[:, :-1].astype(np.float64) @ self.often
        main = np.add.reduceat(np.take(self.directions, flat, axis=0), np.cumsum(n) - n, axis=0)
        return np.concatenate([mine.astype(np.float32), main], axis=1)

    def _near(self, feature, at, stride, items, first, holders, least, counted):
        heads = _bounds(at, stride)
        edges = np.append(heads, len(feature))
        text = np.searchsorted(at, heads, "right") - 1
        follows = np.append(text[1:] == text[:-1], False)  # the next stride is in the same text
        latent = self.latent[items].T
        out: dict[tuple[int, int], list] = {}
        hits, held = [], []
        for part, enough in self._crowded(feature, edges, follows, first, holders, least):
            strides = np.union1d(part, part[follows[part]] + 1)
            each = self._projected(feature, edges, strides)
            sums = each[np.searchsorted(strides, part)]
            sums[follows[part]] += each[np.searchsorted(strides, part[follows[part]] + 1)]
            z = sums @ self.to_latent
            cosine = (z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)) @ latent
            p, k = np.nonzero(np.where(counted, enough, cosine >= LEAST_COSINE))
            hits.append((part[p], k, cosine[p, k]))
            p, k = np.nonzero(enough)
            held.append(np.unique(text[part[p]] * len(items) + k))
        if not hits:
            return []
        part, k, cosine = (np.concatenate(x) for x in zip(*hits, strict=True))
        # a text without a passage that has enough of an item's words holds no match of it
        keep = np.isin(text[part] * len(items) + k, np.concatenate(held))
        part, k, cosine = part[keep], k[keep], cosine[keep]
        rows = (text[part], items[k], heads[part], edges[part + 1 + follows[part]], cosine.astype(np.float64))
        for i, q, a, b, c in zip(*(x.tolist() for x in rows), strict=True):
            runs = out.setdefault((i, q), [])
            if runs and a <= runs[-1][1] + len(self.words[q]):
                runs[-1] = (runs[-1][0], b, max(c, runs[-1][2]))
            else:
                runs.append((a, b, c))
        return [(i, q, a, b, c) for (i, q), runs in out.items() for a, b, c in runs]

    def matches(self, feature, hashes, at) -> list[tuple[int, int, float, float, float]]:
        """(text, item id index, cosine, share of item, share of answer) of true matches."""
        best: dict[tuple[int, int], tuple] = {}
        for i, q, a, b, cosine in self.candidates(feature, at):
            item, answer = self.words[q], self.answers[q]
            reach = _window(len(item))
            region = hashes[max(at[i], a - reach) : min(at[i + 1], b + reach)].tolist()
            share = windowed_share(item, region, self.known[q])
            if share < PART:
                continue
            told = common(answer, region) / len(answer) if answer else share
            found = share >= WHOLE or (share >= PART and told >= ANSWER)
            if len(item) < SHORT:
                found = share >= 1
            if found and share > best.get((i, q), (0, 0))[1]:
                best[i, q] = (cosine, share, told)
        return [(i, q, *x) for (i, q), x in best.items()]


def last_sentence(text: str) -> str:
    parts = [p for p in text.replace("!", ".").replace("?", ".").split(".") if any(c.isalnum() for c in p)]
    return parts[-1] if parts else text


def common(pattern: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of bits at a time."""
    places: dict[int, int] = {}
    for i, x in enumerate(pattern):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(pattern)) - 1
    rows = full
    for x in region:
        hit = places.get(x)
        if hit:
            u = rows & hit
            rows = ((rows + u) | (rows - u)) & full
    return len(pattern) - rows.bit_count()


def windowed_share(item: list[int], region: list[int], known: Set[int]) -> float:
    """Best share of the item's words found in order in half again as many words.

    Words that the item lacks (``known``: its distinct words) are in no common
    subsequence, so windows are compared by the others alone.  Shares below ``PART`` are
    no match: a region is left at 0 when no window has that many of them.
    """
    places = [i for i, x in enumerate(region) if x in known]
    least = PART * len(item)
    if len(places) < least:
        return 0.0
    size = _window(len(item))
    crowd = max(1, math.ceil(least))
    if not any(last - first < size for first, last in zip(places, places[crowd - 1 :])):  # noqa: B905
        return 0.0
    held = [region[i] for i in places]
    if common(item, held) < least:
        return 0.0
    step = max(1, size // 6)
    best = 0
    for a in range(0, max(1, len(region) - size + step), step):
        lo, hi = bisect_left(places, a), bisect_left(places, a + size)
        if hi - lo > best:
            best = max(best, common(item, held[lo:hi]))
    return best / len(item)


def _blocks(benchmark: DataFrame, item: str, text: str, answer: str | None) -> Iterator[list[tuple]]:
    """Items in blocks of fixed number, in the order they come."""
    columns = [F.col(item), F.col(text), F.col(answer) if answer else F.lit(None).cast("string")]
    held: list[tuple] = []
    for row in benchmark.select(*columns).toLocalIterator():
        held.append(tuple(row))
        if len(held) == BLOCK_ITEMS:
            yield held
            held = []
    if held:
        yield held


def _prepared(docs, benchmark, id, text, item, item_text, answer):
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    weights = inverse_frequencies(rows)
    directions = main_directions(rows, weights)
    for block in _blocks(benchmark, item, item_text, answer):
        yield docs.sparkSession.sparkContext.broadcast(vars(Queries(block, weights, directions)))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
) -> DataFrame:
    """(id, item, cosine, item_share, answer_share): one row per text and item it holds."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, cosine double, item_share double, answer_share double"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _prepared(docs, benchmark, id, text, item, item_text, answer):

        def search(batches, shared=shared):
            queries = Queries.of(shared.value)
            for batch in batches:
                for lo, hi, feature, hashes, at in _tokens(batch.column(1)):
                    found = queries.matches(feature, hashes, at)
                    ids = batch.column(0).slice(lo, hi - lo)
                    yield pa.record_batch(
                        [
                            ids.take(pa.array([f[0] for f in found], pa.int64())),
                            pa.array([queries.ids[f[1]] for f in found]).cast(pa.int64()) if item_kind == "bigint" else pa.array([queries.ids[f[1]] for f in found]),
                            *(pa.array([float(f[k]) for f in found], pa.float64()) for k in (2, 3, 4)),
                        ],
                        names=["id", "item", "cosine", "item_share", "answer_share"],
                    )

        out = out.union(rows.mapInArrow(search, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, as they are."""
    at = docs.columns.index(text)
    out = docs
    for shared in _prepared(docs, benchmark, id, text, "item_id", "text", None):

        def clean(batches, shared=shared):
            queries = Queries.of(shared.value)
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for lo, _, feature, hashes, offsets in _tokens(batch.column(at)):
                    for i, *_ in queries.matches(feature, hashes, offsets):
                        keep[lo + i] = False
                yield batch.filter(pa.array(keep))

        out = written(out.mapInArrow(clean, docs.schema), "clean")
    return out
