"""N-gram Jaccard join: size-aware, heavy and light sets apart.

Two texts link when their sets of k-word shingles have a Jaccard similarity of at least
``percent`` / 100.  Two sets of sizes a and b link exactly when they share
o(a, b) = ceil(percent * (a + b) / (100 + percent)) shingles.

* *Light* sets (up to a size chosen by cost) enumerate their subsets of that fixed size,
  for each size a partner may have.  Two light sets link exactly when they meet in a
  subset, so the meetings are links without any check.
* *Heavy* sets scan inverted lists.  A set must share a shingle with each partner within
  its first a - ceil(percent * a / 100) + 1 shingles of one global order, so only those
  are listed.  The order puts shingles of one text first and frequent ones last: they
  are counted over all texts and noted in bitmaps of fixed size.  A shingle that no
  other text has need not be listed.
* The *boundary* is the largest size whose subsets cost less than its list scans, from
  the list lengths counted in these data.

Equal sets are one node from the start.  A list never yields all its pairs: its members
are first checked against one centre per list, over a few rounds; components merge; and
only pairs of nodes still in different components are then taken from their lists and
checked, so groups of near copies cost about their size and no link between different
components is missed.  Every check counts the whole sets.

Shingles are compared by 64-bit hashes; nodes are 64-bit hashes of sets.  Edge cases: a
text without words (null, empty) has an empty set and no links; a null id is kept as a
row, and takes part in its group without naming it; repeated rows are copies; columns
beside id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.llm.graph import components
from musterroll.llm.kernels import U, chunks, mix, shingle_sets
from musterroll.llm.shared import packed, unpacked, written

WORDS, PERCENT = 5, 75
#: A shingle in more than this many texts is frequent.
FREQUENT = 24
#: Shingles in two texts or more are noted in a bitmap of 2**27 bits (16 MB), frequent
#: ones in another of 2**23 (1 MB); fuller maps prune less and change no result.
SHARED_BITS, BITMAP_BITS = 27, 23
#: Text bytes for each group of inverted lists that one task holds at a time.
BYTES_PER_BUCKET = 1 << 20
#: Rounds of checks against one centre per list.
ROUNDS = 2
#: Light sets are sought up to this size; beyond, subsets outnumber any list.
LARGEST_LIGHT = 24
FLUSH = 1 << 20


def overlap(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def partners(a: int, percent: int) -> range:
    return range(-(-percent * a // 100), 100 * a // percent + 1)


def subset_cost(a: int, percent: int, boundary: int) -> int:
    return sum(comb(max(a, 0), overlap(a, b, percent)) for b in partners(a, percent) if b <= boundary and overlap(a, b, percent) <= min(a, b))


def choose_boundary(mean_list: float, percent: int = PERCENT) -> int:
    """Largest size up to which enumerating subsets costs less than scanning lists."""
    best = 0
    for a in range(1, LARGEST_LIGHT + 1):
        prefix = a - -(-percent * a // 100) + 1
        if subset_cost(a, percent, a) > prefix * (1 + mean_list):
            break
        best = a
    return best


def _sets(batches, words: int):
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            hashes, at = shingle_sets(data, offsets, words)
            yield batch.column(0).slice(lo, hi - lo), hashes, at


def _nodes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Node of each set: the sum of its mixed shingles, mixed with its size."""
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes ^ U(0x5555555555555555)), dtype=U)])
    n = np.diff(at).astype(U)
    return mix((sums[at[1:]] - sums[at[:-1]]) ^ mix(n)).view(np.int64)


def _packed(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its columns as bytes."""
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    columns = [c[order] for c in columns]
    heads = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else []
    ends = [*heads[1:], len(buckets)]
    if len(heads):
        yield pa.record_batch(
            [
                pa.array(buckets[heads].astype(np.int32)),
                *(pa.array([c[a:b].tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary()) for c in columns),
            ],
            names=["bucket", *(f"c{i}" for i in range(len(columns)))],
        )


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)


class Join:
    """One join over a table of texts; steps share the settings and the bitmap."""

    def __init__(self, docs: DataFrame, id: str, text: str, words: int, percent: int):
        self.spark = docs.sparkSession
        self.rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        self.words, self.percent = words, percent
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # a power of two, so that buckets are ranges of hashes and of the bitmaps
        self.log_buckets = min(16, max(4, int(size // BYTES_PER_BUCKET).bit_length()))

    def counted(self) -> tuple[bytes, bytes, float]:
        """Bitmaps of shared and of frequent shingles; mean list length of the shared rest.

        A bucket is a range of spread hashes, so it makes its own slices of the bitmaps,
        and 32 bits tell its shingles apart well enough for an order.
        """
        words, log = self.words, self.log_buckets

        def count(batches):
            held, n = [], 0

            def flush():
                spread, counts = np.unique(_spread(np.concatenate(held)), return_counts=True)
                rest = (spread >> U(32 - log)).astype(np.uint32)
                one = counts == 1
                bucket = (spread >> U(64 - log)).astype(np.int64)
                none = np.zeros(0, np.int32)
                for mask in (one, ~one):
                    for part in _packed(bucket[mask], rest[mask], counts[mask].astype(np.int32)):
                        yield part if mask is not one else pa.record_batch(
                            [part.column(0), part.column(1), pa.array([none.tobytes()] * len(part), pa.binary())], names=part.schema.names
                        )

            for _, hashes, _ in _sets(batches, words):
                held.append(hashes)
                n += len(hashes)
                if n >= FLUSH:
                    yield from flush()
                    held, n = [], 0
            if n:
                yield from flush()

        def add(table: pa.Table) -> pa.Table:
            bucket = table.column("bucket")[0].as_py()
            rest, counts = [], []
            for r, c in zip(table.column("c0").to_pylist(), table.column("c1").to_pylist(), strict=True):
                rest.append(np.frombuffer(r, np.uint32))
                counts.append(np.frombuffer(c, np.int32) if c else np.ones(len(rest[-1]), np.int32))
            rest, places = np.unique(np.concatenate(rest), return_inverse=True)
            total = np.bincount(places, weights=np.concatenate(counts), minlength=len(rest))
            slices = []
            for bits, least in ((SHARED_BITS, 1), (BITMAP_BITS, FREQUENT)):
                marks = np.zeros(1 << (bits - log), bool)
                marks[rest[total > least] >> np.uint32(32 - bits + log)] = True
                slices.append(packed(np.packbits(marks)))
            some = total[(total > 1) & (total <= FREQUENT)]
            return pa.table({
                "bucket": pa.array([bucket], pa.int32()), "shared": pa.array([slices[0]], pa.binary()), "frequent": pa.array([slices[1]], pa.binary()),
                "n": [float(some.sum())], "n2": [float((some**2).sum())],
            })

        counts = self.rows.mapInArrow(count, "bucket int, c0 binary, c1 binary")
        found = counts.groupBy("bucket").applyInArrow(add, "bucket int, shared binary, frequent binary, n double, n2 double")
        maps = [bytearray(1 << (bits - 3)) for bits in (SHARED_BITS, BITMAP_BITS)]
        n = n2 = 0.0
        for row in written(found, "frequent").toLocalIterator():  # 17 MB in all, far less for few texts
            for m, name in zip(maps, ("shared", "frequent"), strict=True):
                size = len(m) >> log
                m[row["bucket"] * size : (row["bucket"] + 1) * size] = unpacked(row[name], np.uint8).tobytes()
            n, n2 = n + row["n"], n2 + row["n2"]
        return bytes(maps[0]), bytes(maps[1]), n2 / n if n else 0.0

    def lists(self, maps, boundary: int) -> DataFrame:
        """Members of inverted lists and subset groups with two nodes or more.

        (token, node, n, light, own): ``light`` is 0 for lists, else the smaller and the
        larger size of a subset group as ``1000 * a + b``; ``place`` is the shingle's in
        the order of the set.
        """
        words, percent, log = self.words, self.percent, self.log_buckets
        listed_from = -(-percent * (boundary + 1) // 100) if boundary else 1

        def post(batches):
            held, n = [], 0
            for _, hashes, at in _sets(batches, words):
                sizes, nodes = np.diff(at), _nodes(hashes, at)
                _, first = np.unique(nodes, return_index=True)
                keep = np.zeros(len(nodes), dtype=bool)
                keep[first] = True  # copies in one batch post once
                held.append(_prefix(hashes, at, np.where(keep & (sizes >= listed_from), sizes, 0), nodes, maps.value, percent))
                for i in np.flatnonzero(keep & (sizes > 0) & (sizes <= boundary)):
                    held.append(_subsets(hashes[at[i] : at[i + 1]], nodes[i], percent, boundary))
                n += len(hashes)
                if n >= 4 * FLUSH:
                    yield from flush(held)
                    held, n = [], 0
            if held:
                yield from flush(held)

        def flush(held):
            token, *rest = (np.concatenate([x[i] for x in held]) for i in range(5))
            yield from _packed((_spread(token.view(U)) >> U(64 - log)).astype(np.int64), token, *rest)

        def gather(table: pa.Table) -> pa.Table:
            token, node = _column(table, "c0", np.int64), _column(table, "c1", np.int64)
            n, light, place = (_column(table, c, np.int32) for c in ("c2", "c3", "c4"))
            order = np.lexsort((node, token, light))
            token, node, n, light, place = (x[order] for x in (token, node, n, light, place))
            new = np.ones(len(token), dtype=bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1]) | (light[1:] != light[:-1])
            token, node, n, light, place = (x[new] for x in (token, node, n, light, place))
            same = (token[1:] == token[:-1]) & (light[1:] == light[:-1])
            many = np.zeros(len(token), dtype=bool)
            many[1:] |= same
            many[:-1] |= same
            columns = {"token": token, "node": node, "n": n, "light": light, "place": place}
            return pa.table({k: v[many] for k, v in columns.items()})

        posted = self.rows.mapInArrow(post, "bucket int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary")
        found = posted.groupBy("bucket").applyInArrow(gather, "token long, node long, n int, light int, place int")
        return written(found, "lists")

    def sets(self, lists: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes that lists mention; a bitmap picks them early."""
        words = self.words
        bits = lists.select(F.pmod(F.col("node"), F.lit(1 << BITMAP_BITS)).cast("int").alias("bit"))
        wanted = self.spark.sparkContext.broadcast(_bitmap(bits))

        def pick(batches):
            marks = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).astype(bool)
            for _, hashes, at in _sets(batches, words):
                nodes = _nodes(hashes, at)
                _, first = np.unique(nodes, return_index=True)
                hit = [i for i in first if at[i] < at[i + 1] and marks[nodes[i] % (1 << BITMAP_BITS)]]
                yield pa.record_batch(
                    [
                        pa.array(nodes[hit], pa.int64()),
                        pa.array([hashes[at[i] : at[i + 1]].tobytes() for i in hit], pa.binary()),
                    ],
                    names=["node", "shingles"],
                )

        found = self.rows.mapInArrow(pick, "node long, shingles binary")
        sets = written(found.join(lists.select("node").distinct(), "node").dropDuplicates(["node"]), "sets")
        wanted.destroy()
        return sets

    def checked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs (u, v) whose whole sets are similar enough, with their overlap."""
        percent = self.percent

        def count(batches):
            for batch in batches:
                a, b = batch.column(2), batch.column(3)
                shared = np.zeros(len(a), dtype=np.int64)
                union = np.zeros(len(a), dtype=np.int64)
                for i in range(len(a)):
                    x, y = np.frombuffer(a[i].as_buffer(), U), np.frombuffer(b[i].as_buffer(), U)
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    shared[i] = np.count_nonzero(both[1:] == both[:-1])
                    union[i] = len(both) - shared[i]
                ok = 100 * shared >= percent * union
                yield pa.record_batch(
                    [batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok)), pa.array(shared[ok]), pa.array(union[ok])],
                    names=["u", "v", "shared", "all"],
                )

        left = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
        both = left.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        return both.select("u", "v", "a", "b").mapInArrow(count, "u long, v long, shared long, all long")

    def links(self) -> DataFrame:
        """Links (u, v) between nodes that connect exactly the nodes that links connect."""
        shared, frequent, mean_list = self.counted()
        boundary = choose_boundary(mean_list, self.percent)
        maps = self.spark.sparkContext.broadcast((shared, frequent))
        del shared, frequent
        lists = self.lists(maps, boundary)
        maps.destroy()
        heavy, light = lists.where("light = 0"), lists.where("light > 0")
        known = written(_light_links(light), "links")
        if heavy.limit(1).count() == 0:
            return known
        sets = self.sets(heavy)
        tried = None
        p = self.percent
        # a pair's first shared shingle has all the others of both sets after it
        left = F.least(F.col("xn") - F.col("xp"), F.col("yn") - F.col("yp"))
        fits = (100 + p) * left >= p * (F.col("xn") + F.col("yn"))
        for turn in range(ROUNDS + 1):
            labels = components(known) if turn else None
            live = heavy
            if labels is not None:
                live = heavy.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
                mixed = live.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
                live = live.join(mixed.select("token"), "token")
            else:
                live = live.withColumn("c", F.col("node"))
            live = written(live.select("token", "node", "n", "c", "place"), "live")
            if turn < ROUNDS:
                # first the member with the fewest shingles of its own, likeliest the text copied
                by = F.col("place").cast("bigint") if turn == 0 else F.xxhash64("node", F.lit(turn))
                centre = live.groupBy("token").agg(F.min(F.struct(by.alias("by"), "node", "n", "c", "place")).alias("m"))
                pairs = live.join(centre, "token").select(*_side("x"), *_side("y", "m."))
            else:
                pairs = live.select("token", *_side("x")).join(live.select("token", *_side("y")), "token")
                pairs = pairs.where(F.col("xc") < F.col("yc"))
            pairs = pairs.where((F.col("xc") != F.col("yc")) & fits)
            pairs = pairs.select(F.greatest("x", "y").alias("v"), F.least("x", "y").alias("u")).distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["u", "v"], "left_anti")
            pairs = written(pairs, "pairs")
            tried = pairs if tried is None else tried.union(pairs)
            new = self.checked(pairs, sets).select("u", "v")
            known = written(known.union(new), "links")
        return known

    def members(self) -> DataFrame:
        """(id, node, n) of every text; node is null for an empty set."""
        words = self.words

        def of(batches):
            for ids, hashes, at in _sets(batches, words):
                n = np.diff(at)
                yield pa.record_batch(
                    [ids, pa.array(_nodes(hashes, at), pa.int64(), mask=n == 0), pa.array(n.astype(np.int64))],
                    names=["id", "node", "n"],
                )

        kind = self.rows.schema["id"].dataType.simpleString()
        return self.rows.mapInArrow(of, f"id {kind}, node long, n long")


def _spread(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ U(0x2545F4914F6CDD1D))


def _marked(bitmap: bytes, bits: int, spread: np.ndarray) -> np.ndarray:
    marks = np.frombuffer(bitmap, np.uint8)
    bit = (spread >> U(64 - bits)).astype(np.int64)
    return ((marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)


def _bitmap(bits: DataFrame) -> bytes:
    """The set bits of a column ``bit`` below 2**BITMAP_BITS, packed: 1 MB at most.

    Words of the map meet as numbers, so the driver gets a bounded table of them.
    """
    word, value = F.shiftright("bit", 6), F.lit(1).cast("bigint")
    flags = F.call_function("shiftleft", value, F.col("bit").bitwiseAND(63))
    packed = bits.groupBy(word.alias("word")).agg(F.bit_or(flags).alias("flags"))
    words = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    for row in packed.toLocalIterator(prefetchPartitions=True):
        words[row["word"]] = row["flags"]
    return np.packbits(np.unpackbits(words.view(np.uint8), bitorder="little")).tobytes()


def _prefix(hashes, at, sizes, nodes, maps, percent):
    """Postings of the texts whose size here is not 0: (token, node, n, light 0).

    Order of a text's shingles: those that no other text has, shared ones, frequent
    ones; by hash within each kind.  The first kind is not posted.
    """
    spread = _spread(hashes)
    frequent = _marked(maps[1], BITMAP_BITS, spread)
    alone = ~frequent & ~_marked(maps[0], SHARED_BITS, spread)
    n = np.diff(at)
    text = np.repeat(np.arange(len(n)), n)

    def before(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[:-1] - sums[at[:-1]][text], (sums[at[1:]] - sums[at[:-1]])[text]

    alone_before, all_alone = before(alone)
    frequent_before, all_frequent = before(frequent)
    rank = np.arange(len(hashes)) - at[:-1][text]
    place = np.where(
        frequent, n[text] - all_frequent + frequent_before, all_alone + rank - alone_before - frequent_before
    )
    length = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
    keep = ~alone & (place < length[text])
    return (
        hashes[keep].view(np.int64),
        nodes[text[keep]],
        n[text[keep]].astype(np.int32),
        np.zeros(int(keep.sum()), np.int32),
        place[keep].astype(np.int32),
    )


def _subsets(shingles, node, percent, boundary):
    """Subset groups of one light set, for every size of a light partner."""
    a, tokens, light = len(shingles), [], []
    for b in partners(a, percent):
        size = overlap(a, b, percent)
        if b > boundary or size > min(a, b):
            continue
        pick = np.array(list(combinations(range(a), size)), dtype=np.int64)
        tokens.append(mix(mix(shingles[pick]).sum(axis=1, dtype=U)))
        light.append(np.full(len(pick), 1000 * min(a, b) + max(a, b), np.int32))
    token = np.concatenate(tokens) if tokens else np.zeros(0, U)
    return (
        token.view(np.int64),
        np.full(len(token), node, np.int64),
        np.full(len(token), a, np.int32),
        np.concatenate(light) if light else np.zeros(0, np.int32),
        np.zeros(len(token), np.int32),
    )


def _side(end: str, of: str = "") -> list[Column]:
    """A list member's columns as one end of a pair: x, xn, xc, xp."""
    names = {"node": "", "n": "n", "c": "c", "place": "p"}
    return [F.col(of + name).alias(end + short) for name, short in names.items()]


def _light_links(light: DataFrame) -> DataFrame:
    """Members of a subset group link to the smallest node of the other size."""
    small, large = F.floor(F.col("light") / 1000), F.col("light") % 1000
    ends = light.groupBy("token", "light").agg(
        F.min(F.when(F.col("n") == small, F.col("node"))).alias("lo"),
        F.min(F.when(F.col("n") == large, F.col("node"))).alias("hi"),
    )
    met = light.join(ends.where("lo is not null and hi is not null"), ["token", "light"])
    to = F.when(F.col("n") == small, F.col("hi")).otherwise(F.col("lo"))
    return met.select(F.col("node").alias("u"), to.alias("v")).where("u != v").distinct()


def _grouped(join: Join) -> DataFrame:
    """(id, node, n, c) of every text; c is the group's smallest node, null for no words."""
    labels = written(components(join.links()), "labels")
    rows = join.members().join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
    return written(rows.select("id", "node", "n", "c"), "members")


def jaccard_join(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id that links reach from the text, itself included.
    """
    rows = _grouped(Join(docs, id, text, words, percent))
    least = rows.where("c is not null").groupBy("c").agg(F.min("id").alias("least"))
    return rows.join(least, "c", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` with one of each group: that with the smallest id, as it is.

    Texts without words link with nothing, so all of them stay; a null id stands for its
    group only where no row has an id; of equal rows one stays.
    """
    rows = _grouped(Join(docs, id, text, words, percent))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "node"))
    chosen = rows.where("c is not null").groupBy("c").agg(first.alias("m"))
    own = "_node" + "_" * max(map(len, docs.columns))  # longer than any name there is
    chosen = chosen.select(F.col("m.id").alias(own + "id"), F.col("m.node").alias(own + "of"))
    at = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            texts = pa.record_batch([pa.nulls(len(batch)), batch.column(at)], names=["none", "text"])
            nodes = [(_nodes(hashes, offsets), np.diff(offsets) == 0) for _, hashes, offsets in _sets([texts], words)]
            node = pa.array(np.concatenate([x for x, _ in nodes]), pa.int64(), mask=np.concatenate([x for _, x in nodes])) if nodes else pa.nulls(0, pa.int64())
            yield pa.record_batch([*batch.columns, node], names=[*batch.schema.names, own])

    noded = docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]))
    same = (F.col(own) == F.col(own + "of")) & F.col(id).eqNullSafe(F.col(own + "id"))
    kept = noded.where(F.col(own).isNotNull()).join(chosen, same).dropDuplicates([own, id])
    return kept.select(*docs.columns).union(noded.where(F.col(own).isNull()).select(*docs.columns))
