"""Suffix-array dedup: cut every byte covered by a long string that starts elsewhere too.

Suffix arrays are built shard by shard.  So that equal strings of ``length`` bytes meet
in one shard, every text is winnowed: of each window of k-gram hashes that fits into
such a string the smallest is chosen, so two equal strings choose an equal one.  Chosen
k-grams that occur at least twice, with the bytes around them that a string through them
can cover, are dealt to shards by their hash.  Surroundings that are equal as a whole
need no sorting: they are repeated, and one of them stands for all in the shard.

In a shard, suffixes are classified, leftmost-smaller suffixes (LMS) are sorted by
induction and named, names are doubled until they tell ``length`` bytes apart, and their
order induces the array; all steps run bucket by bucket on whole arrays.  The permuted
common prefixes (each suffix with the one before it in the array) then say which strings
are repeated.  Doubling of names stands in for a second induced level, whose buckets
would hold a suffix or two each.

A k-gram with very many different surroundings would fill a shard by itself.  Strings
through such a crowded k-gram are dealt out one by one, as hashes of all their bytes,
and meet in the shuffle; that is the same question asked without an order.

Equal texts are one text from the start; if they are long enough, all of each is cut.

Edge cases: null and empty texts have 0 bytes and the checksum of nothing; texts shorter
than ``length`` stay whole; a null id stays; repeated rows are copies; columns other than
id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.jaccard import BITMAP_BITS, FLUSH, _bitmap, _column, _packed
from musterroll.llm.kernels import U, buffers, chunks, digest, mix, prefix_hash, span_hash
from musterroll.llm.shared import written

LENGTH, GRAM = 200, 32
#: Texts are worked on in segments of so many bytes at most, some 25 MB of arrays.
SEGMENT = 1 << 18
_PLACE_BITS = 24
SHARD_BYTES = 1 << 19
#: A k-gram with more different surroundings than this is crowded.
CROWDED = 1024
#: Text bytes for each group of fingerprints that one task holds at a time.
BYTES_PER_BUCKET = 4 << 20


# ---------------------------------------------------------------- fingerprints


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(values)
    if n < width:
        return values[:0]
    pad = -n % width
    full = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, U)]).reshape(-1, width)
    forward = np.minimum.accumulate(full, axis=1).ravel()
    backward = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def _thin(places: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
    """Which chosen places to keep: in a run of one hash, the ends of each half window."""
    if not len(places):
        return np.zeros(0, bool)
    run = np.ones(len(places), bool)
    run[1:] = (hashes[1:] != hashes[:-1]) | (places[1:] - places[:-1] > width)
    start = places[np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))]
    block = (places - start) // (width // 2)
    first = run.copy()
    first[1:] |= block[1:] != block[:-1]
    last = np.ones(len(places), bool)
    last[:-1] = first[1:]
    return first | last


def fingerprints(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Chosen k-grams of texts: (text, place, hash, hash of surroundings, bytes after)."""
    width = length - gram + 1
    parts = []
    for lo in range(0, max(len(data) - length + 1, 1), SEGMENT):
        a, b = max(0, lo - length), min(len(data), lo + SEGMENT + 2 * length)
        piece = data[a:b]
        if len(piece) < length:
            continue
        sums = prefix_hash(piece)
        at = np.arange(len(piece) - gram + 1)
        hashes = span_hash(sums, at, at + gram)
        order = (hashes >> U(_PLACE_BITS) << U(_PLACE_BITS)) | at.astype(U)
        least = sliding_minimum(order, width)
        begins = np.arange(a, a + len(least))
        ends = offsets[np.searchsorted(offsets, begins, "right").clip(max=len(offsets) - 1)]
        inside = (begins >= lo) & (begins < lo + SEGMENT) & (begins + length <= ends)
        chosen = least[inside]
        if not len(chosen):
            continue
        chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
        local = (chosen & U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        local = local[_thin(local, hashes[local], width)]
        place = local + a
        text = np.searchsorted(offsets, place, "right") - 1
        left = np.minimum(place - offsets[text], width - 1)
        right = np.minimum(offsets[text + 1] - place, length)
        around = span_hash(sums, local - left, local + right) ^ mix((left * (length + 1) + right).astype(U))
        parts.append((text, place - offsets[text], hashes[local], around, right))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U), none.astype(U), none
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(5))


def text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each whole text, from a digest: long texts may be built alike."""
    out = [digest(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.array(out, U).view(np.int64)


# ---------------------------------------------------------------- suffix arrays


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the smallest."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    step[-1] = 1
    at = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[nearest] > 0


def _deal(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, counts, and the number of each entry among its symbol."""
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=size)
    starts = np.cumsum(counts) - counts
    ranked = symbols[order]
    return order, counts, np.arange(len(symbols)) - starts[ranked]


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Suffix array that a given order of LMS suffixes induces, a bucket at a time."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    counts = np.bincount(s, minlength=size)
    heads = np.cumsum(counts) - counts
    tails = heads + counts
    order, lms_counts, _ = _deal(s[lms], size)
    lms_sorted, lms_heads = lms[order], np.cumsum(lms_counts) - lms_counts
    large = ~small

    def push(batch, pointer, wanted, upward):
        before = batch[batch > 0] - 1
        before = before[wanted[before]]
        if not len(before):
            return
        symbols = s[before]
        order, many, number = _deal(symbols, size)
        symbols, before = symbols[order], before[order]
        if upward:
            sa[pointer[symbols] + number] = before
            pointer += many
        else:
            sa[pointer[symbols] - 1 - number] = before
            pointer -= many

    pointer = heads.copy()
    for c in np.flatnonzero(counts):
        lo = heads[c]
        while lo < pointer[c]:
            hi = pointer[c]
            push(sa[lo:hi].copy(), pointer, large, True)
            lo = hi
        if lms_counts[c]:
            push(lms_sorted[lms_heads[c] : lms_heads[c] + lms_counts[c]], pointer, large, True)
    larges = pointer - heads
    pointer = tails.copy()
    sa[0] = n - 1  # the sentinel; every other small suffix is induced now
    for c in np.flatnonzero(counts)[::-1]:
        hi = tails[c]
        while hi > pointer[c]:
            lo = pointer[c]
            push(sa[lo:hi][::-1].copy(), pointer, small, False)
            hi = lo
        if larges[c]:
            push(sa[heads[c] : heads[c] + larges[c]][::-1].copy(), pointer, small, False)
    sa[0] = n - 1
    return sa


def suffix_array(s: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol is its only 0.

    With ``depth``, suffixes that agree in so many symbols may stand in any order.
    """
    n, size = len(s), int(s.max()) + 1
    if n == 1:
        return np.zeros(1, np.int32)
    small = _types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    by_substring = induce(s, small, lms, size)
    ordered = by_substring[is_lms[by_substring]]
    number = np.cumsum(is_lms) - 1
    ends = np.append(lms[1:] + 1, n)  # an LMS substring ends with the next LMS symbol
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(s.astype(U) + U(1)) * _powers_for(n))])
    hashes = span_hash(sums, lms, ends)
    place = number[ordered]
    lengths = (ends - lms)[place]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = (hashes[place][1:] != hashes[place][:-1]) | (lengths[1:] != lengths[:-1])
    names = np.zeros(len(lms), np.int64)
    names[place] = np.cumsum(fresh) - 1
    names = _double(names, None if depth is None else depth // 2 + 1)
    return induce(s, small, lms[np.argsort(names, kind="stable")], size)


def _powers_for(n: int) -> np.ndarray:
    from musterroll.llm.kernels import powers

    return powers(n)[0]


def _double(names: np.ndarray, reach: int | None) -> np.ndarray:
    """Ranks of the suffixes of a string of names; each round doubles what they cover."""
    step, m = 1, len(names)
    while (reach is None or step < reach) and int(names.max(initial=0)) + 1 < m:
        after = np.zeros(m, np.int64)
        after[: m - step] = names[step:] + 1
        pair = names * (m + 1) + after
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        fresh = np.zeros(m, np.int64)
        fresh[1:] = ranked[1:] != ranked[:-1]
        names = np.empty(m, np.int64)
        names[order] = np.cumsum(fresh)
        step *= 2
    return names


def common_prefixes(s: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes, up to ``limit``: of each suffix and its predecessor."""
    n = len(s)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(s.astype(U) + U(1)) * _powers_for(n))])
    before = np.full(n, n - 1, np.int64)
    before[sa[1:]] = sa[:-1]
    here, shared = np.arange(n), np.zeros(n, np.int64)
    step = 1 << max(limit.bit_length() - 1, 0)
    while step:
        a, b = here + shared, before + shared
        fits = (shared + step <= limit) & (a + step <= n) & (b + step <= n)
        at = np.flatnonzero(fits)
        same = span_hash(sums, a[at], a[at] + step) == span_hash(sums, b[at], b[at] + step)
        shared[at[same]] += step
        step >>= 1
    shared[sa[0]] = 0
    return shared


def repeated_starts(regions: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each region, the places of strings of ``length`` bytes that start elsewhere too."""
    sizes = np.array([len(r) for r in regions])
    s = np.zeros(int(sizes.sum()) + len(regions) + 1, np.int16)
    heads = np.cumsum(sizes + 1) - sizes - 1
    for at, region in zip(heads, regions, strict=True):
        s[at : at + len(region)] = region.astype(np.int16) + 2
        s[at + len(region)] = 1
    left = np.zeros(len(s), np.int64)
    for at, n in zip(heads, sizes, strict=True):
        left[at : at + n] = np.arange(n, 0, -1)
    sa = suffix_array(s, length)
    shared = common_prefixes(s, sa, length)
    hit = (shared >= length) & (left >= length)
    twin = np.zeros(len(s), bool)  # the predecessor in the array has the same string
    twin[sa[:-1]] = hit[sa[1:]]
    hit |= twin & (left >= length)
    return [np.flatnonzero(hit[at : at + n]) for at, n in zip(heads, sizes, strict=True)]


# ---------------------------------------------------------------- Spark steps


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(order) else ends
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1) if len(starts) else np.zeros(0, np.int64)
    return starts[new], ends[last]


def _keyed(batches):
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            yield batch.slice(lo, hi - lo), text_keys(data, offsets), data, offsets


def _marked(bits: bytes, keys: np.ndarray) -> np.ndarray:
    marks = np.frombuffer(bits, np.uint8)
    bit = keys % (1 << BITMAP_BITS)
    return ((marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)


def _bits_of(keys: DataFrame) -> bytes:
    return _bitmap(keys.select(F.pmod("key", F.lit(1 << BITMAP_BITS)).cast("int").alias("bit")))


class _Dedup:
    def __init__(self, docs: DataFrame, id: str, text: str, length: int, gram: int):
        self.spark, self.length, self.gram = docs.sparkSession, length, gram
        self.rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        self.id_type = self.rows.schema["id"].dataType.simpleString()
        self.size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def copies(self) -> DataFrame:
        """Texts of several rows, as spans over all of them: (key, start, end)."""
        length = self.length

        def of(batches):
            for _, keys, _, offsets in _keyed(batches):
                n = np.diff(offsets)
                long = n >= length
                yield pa.record_batch([pa.array(keys[long]), pa.array(n[long])], names=["key", "n"])

        found = self.rows.mapInArrow(of, "key long, n long").groupBy("key", "n").agg(F.count("*").alias("rows"))
        return found.where("rows > 1").select("key", F.lit(0).cast("bigint").alias("start"), F.col("n").alias("end"))

    def meetings(self) -> DataFrame:
        """Spans repeated as a whole, and places whose surroundings must be compared.

        (key, start, end, gram, crowded): a span where ``gram`` is null, else the place
        ``start``.
        """
        length, gram = self.length, self.gram
        buckets = max(16, -(-self.size // BYTES_PER_BUCKET))

        def post(batches):
            held, n = [], 0

            def flush():
                columns = [np.concatenate([h[i] for h in held]) for i in range(5)]
                yield from _packed((mix(columns[0]) % U(buckets)).astype(np.int64), *columns)

            for _, keys, data, offsets in _keyed(batches):
                text, place, grams, around, right = fingerprints(data, offsets, length, gram)
                first = np.zeros(len(keys), bool)
                first[np.unique(keys, return_index=True)[1]] = True
                keep = first[text]  # copies in one batch post once
                held.append((grams[keep], around[keep], keys[text[keep]], place[keep].astype(np.int32), right[keep].astype(np.int16)))
                n += int(keep.sum())
                if n >= FLUSH // 4:
                    yield from flush()
                    held, n = [], 0
            if n:
                yield from flush()

        def meet(table: pa.Table) -> pa.Table:
            grams, around, keys = _column(table, "c0", U), _column(table, "c1", U), _column(table, "c2", np.int64)
            place, right = _column(table, "c3", np.int32).astype(np.int64), _column(table, "c4", np.int16).astype(np.int64)
            order = np.lexsort((place, keys, around, grams))
            grams, around, keys, place, right = grams[order], around[order], keys[order], place[order], right[order]
            if len(grams):
                head = np.ones(len(grams), bool)
                head[1:] = (grams[1:] != grams[:-1]) | (around[1:] != around[:-1]) | (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])
                grams, around, keys, place, right = grams[head], around[head], keys[head], place[head], right[head]
            by_gram, by_around = np.ones(len(grams), bool), np.ones(len(grams), bool)
            by_gram[1:] = grams[1:] != grams[:-1]
            by_around[1:] = by_gram[1:] | (around[1:] != around[:-1])
            which = np.cumsum(by_around) - 1
            equal = np.bincount(which)[which] > 1 if len(which) else by_gram
            group = np.cumsum(by_gram) - 1
            kinds = np.bincount(group, weights=by_around)[group] if len(group) else np.zeros(0)
            left = np.minimum(place, length - gram)
            whole = equal & (left + right >= length)
            ask = by_around & (kinds > 1)
            none = np.zeros(int(whole.sum()), bool)
            crowded = kinds > CROWDED
            return pa.table({
                "key": np.concatenate([keys[whole], keys[ask]]),
                "start": np.concatenate([(place - left)[whole], place[ask]]),
                "end": np.concatenate([(place + right)[whole], place[ask]]),
                "gram": pa.array(
                    np.concatenate([np.zeros(len(none), np.int64), grams[ask].view(np.int64)]),
                    mask=np.concatenate([~none, np.zeros(int(ask.sum()), bool)]),
                ),
                "crowded": np.concatenate([none, crowded[ask]]),
            })

        packed = self.rows.mapInArrow(post, "bucket int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary")
        found = packed.groupBy("bucket").applyInArrow(meet, "key long, start long, end long, gram long, crowded boolean")
        return written(found, "meetings")

    def texts(self, keys: DataFrame) -> DataFrame:
        """(id, text, key) of the rows whose key may be among ``keys``, by a bitmap."""
        wanted = self.spark.sparkContext.broadcast(_bits_of(keys))

        def pick(batches):
            for part, found, _, _ in _keyed(batches):
                hit = pa.array(_marked(wanted.value, found))
                keyed = pa.record_batch([part.column(0), part.column(1), pa.array(found)], names=["id", "text", "key"])
                yield keyed.filter(hit)

        return self.rows.mapInArrow(pick, f"id {self.id_type}, text string, key long")

    def crowded_spans(self, asked: DataFrame) -> DataFrame:
        """Repeated strings through the asked places, by hashes of the strings."""
        length, gram = self.length, self.gram
        total = asked.count() * (length - gram + 1)
        buckets = max(8, -(-total // FLUSH))
        places = asked.groupBy("key").agg(F.collect_set("start").alias("places"))
        one = self.texts(asked).select("key", "text").dropDuplicates(["key"])

        def deal(batches):
            for batch in batches:
                held, n = [], 0
                for lo, hi, data, offsets in chunks(batch.column("text")):
                    sums = prefix_hash(data)
                    for i in range(lo, hi):
                        place = np.sort(np.array(batch.column("places")[i].as_py(), np.int64))
                        a, b = offsets[i - lo], offsets[i - lo + 1]
                        first = np.maximum(place - (length - gram), 0)
                        firsts, ends = merged(first, np.minimum(place, b - a - length) + 1)
                        starts = np.concatenate([np.arange(x, y) for x, y in zip(firsts, ends, strict=True)] + [np.zeros(0, np.int64)])
                        hashes = span_hash(sums, a + starts, a + starts + length)
                        held.append((hashes, np.full(len(starts), batch.column("key")[i].as_py(), np.int64), starts.astype(np.int32)))
                        n += len(starts)
                        if n >= FLUSH // 2:
                            yield from flush(held)
                            held, n = [], 0
                if n:
                    yield from flush(held)

        def flush(held):
            columns = [np.concatenate([h[i] for h in held]) for i in range(3)]
            yield from _packed((mix(columns[0]) % U(buckets)).astype(np.int64), *columns)

        def meet(table: pa.Table) -> pa.Table:
            hashes, keys, starts = _column(table, "c0", U), _column(table, "c1", np.int64), _column(table, "c2", np.int32)
            order = np.lexsort((starts, keys, hashes))
            hashes, keys, starts = hashes[order], keys[order], starts[order].astype(np.int64)
            same = hashes[1:] == hashes[:-1]
            hit = np.zeros(len(hashes), bool)
            hit[1:] |= same
            hit[:-1] |= same
            keys, starts = keys[hit], starts[hit]
            order = np.lexsort((starts, keys))
            keys, starts = keys[order], starts[order]
            new = np.ones(len(keys), bool)  # runs of neighbouring starts are one span
            new[1:] = (keys[1:] != keys[:-1]) | (starts[1:] - starts[:-1] > length)
            last = np.append(np.flatnonzero(new)[1:] - 1, len(keys) - 1) if len(keys) else np.zeros(0, np.int64)
            return pa.table({"key": keys[new], "start": starts[new], "end": starts[last] + length})

        packed = one.join(places, "key").mapInArrow(deal, "bucket int, c0 binary, c1 binary, c2 binary")
        return packed.groupBy("bucket").applyInArrow(meet, "key long, start long, end long")

    def sorted_spans(self, asked: DataFrame) -> DataFrame:
        """Repeated strings among the surroundings of the asked places, from suffix arrays."""
        length, gram = self.length, self.gram
        total = asked.count() * 2 * length
        shards = max(8, -(-total // SHARD_BYTES))
        places = asked.groupBy("key").agg(F.collect_list("start").alias("places"), F.collect_list("gram").alias("grams"))
        one = self.texts(asked).select("key", "text").dropDuplicates(["key"])

        def surround(batches):
            for batch in batches:
                data, offsets = buffers(batch.column("text"))
                lists = batch.column("places")
                at = np.asarray(lists.offsets.to_numpy()) - lists.offsets[0].as_py()
                place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                grams = batch.column("grams").flatten().to_numpy(zero_copy_only=False).view(U)
                text = np.repeat(np.arange(len(batch)), np.diff(at))
                start = np.maximum(place - (length - gram), 0)
                end = np.minimum(place + length, np.diff(offsets)[text])
                keys = batch.column("key").to_numpy()[text]
                shard = (mix(grams) % U(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], shard[order][1:] != shard[order][:-1]])) if len(order) else []
                rows = {k: [] for k in ("shard", "keys", "starts", "ends", "bytes")}
                for a, b in zip(heads, [*heads[1:], len(order)], strict=True):
                    own = order[a:b]
                    rows["shard"].append(int(shard[own[0]]))
                    for name, x in (("keys", keys), ("starts", start), ("ends", end)):
                        rows[name].append(x[own].tobytes())
                    rows["bytes"].append(b"".join(data[offsets[text[i]] + start[i] : offsets[text[i]] + end[i]].tobytes() for i in own))
                yield pa.record_batch(
                    [pa.array(rows["shard"], pa.int32()), *(pa.array(rows[k], pa.binary()) for k in ("keys", "starts", "ends", "bytes"))],
                    names=list(rows),
                )

        def sort(table: pa.Table) -> pa.Table:
            keys, starts, ends = (_column(table, k, np.int64) for k in ("keys", "starts", "ends"))
            data = _column(table, "bytes", np.uint8)
            at = np.cumsum(ends - starts) - (ends - starts)
            order = np.lexsort((ends, starts, keys))
            regions, owner = [], []  # surroundings that touch become one region
            i = 0
            while i < len(order):
                j = order[i]
                key, low, high, pieces = keys[j], starts[j], ends[j], [data[at[j] : at[j] + ends[j] - starts[j]]]
                i += 1
                while i < len(order) and keys[order[i]] == key and starts[order[i]] <= high:
                    j = order[i]
                    if ends[j] > high:
                        pieces.append(data[at[j] + high - starts[j] : at[j] + ends[j] - starts[j]])
                        high = ends[j]
                    i += 1
                regions.append(np.concatenate(pieces))
                owner.append((key, low))
            out_key, out_start, out_end = [], [], []
            for (key, low), hits in zip(owner, repeated_starts(regions, length) if regions else [], strict=True):
                a, b = merged(hits + low, hits + low + length)
                out_key.append(np.full(len(a), key, np.int64))
                out_start.append(a)
                out_end.append(b)
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            return pa.table({"key": join(out_key), "start": join(out_start), "end": join(out_end)})

        packed = one.join(places, "key").mapInArrow(surround, "shard int, keys binary, starts binary, ends binary, bytes binary")
        return packed.groupBy("shard").applyInArrow(sort, "key long, start long, end long")

    def cut(self, spans: DataFrame) -> DataFrame:
        """Every row with its spans cut out."""
        wanted = self.spark.sparkContext.broadcast(_bits_of(spans))
        kind = f"id {self.id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans binary"

        def rows(ids, data, offsets, spans_of):
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
            for i in range(len(ids)):
                text = data[offsets[i] : offsets[i + 1]]
                starts, ends = spans_of(i)
                keep = np.ones(len(text), bool)
                for a, b in zip(starts, ends, strict=True):
                    keep[a:b] = False
                kept = text[keep].tobytes() if len(starts) else text.tobytes()
                for name, x in (
                    ("n_bytes", len(text)), ("n_removed", len(text) - len(kept)), ("n_spans", len(starts)),
                    ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept if len(starts) else None),
                    ("spans", np.stack([starts, ends], 1).astype(np.int64).tobytes() if len(starts) else b""),
                ):
                    out[name].append(x)
            types = {"kept": pa.binary(), "spans": pa.binary(), "kept_sha256": pa.string()}
            return pa.record_batch(
                [ids, *(pa.array(v, types.get(k, pa.int64())) for k, v in out.items())], names=["id", *out]
            )

        none = np.zeros(0, np.int64)

        def untouched(batches):
            for part, keys, data, offsets in _keyed(batches):
                miss = np.flatnonzero(~_marked(wanted.value, keys))
                if len(miss):
                    ids, text = part.column(0).take(pa.array(miss)), part.column(1).take(pa.array(miss))
                    yield rows(ids, *buffers(text), lambda i: (none, none))

        def touched(batches):
            for batch in batches:
                for lo, hi, data, offsets in chunks(batch.column("text")):
                    starts, ends = batch.column("starts").slice(lo, hi - lo).to_pylist(), batch.column("ends").slice(lo, hi - lo).to_pylist()

                    def spans_of(i, starts=starts, ends=ends):
                        if not starts[i]:
                            return none, none
                        return merged(np.array(starts[i], np.int64), np.array(ends[i], np.int64))

                    yield rows(batch.column("id").slice(lo, hi - lo), data, offsets, spans_of)

        by_key = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("s"))
        by_key = by_key.select("key", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
        hit = self.texts(spans).join(by_key, "key", "left").select("id", "text", "starts", "ends")
        return self.rows.mapInArrow(untouched, kind).union(hit.mapInArrow(touched, kind))


def suffix_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int | None = None
) -> DataFrame:
    """Cut repeated strings: (id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans).

    ``kept`` holds the remaining bytes of texts that lost some (else null: the text as it
    is), ``spans`` the removed runs as pairs of 64-bit numbers.
    """
    job = _Dedup(docs, id, text, length, gram or min(GRAM, max(1, length // 4)))
    met = job.meetings()
    spans = written(
        job.copies()
        .unionByName(met.where("gram is null").drop("gram", "crowded"))
        .unionByName(job.sorted_spans(met.where("gram is not null and not crowded")))
        .unionByName(job.crowded_spans(met.where("gram is not null and crowded"))),
        "spans",
    )
    return job.cut(spans)
