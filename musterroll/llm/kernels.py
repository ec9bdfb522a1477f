"""Array kernels over batches of whole texts.

The texts of an Arrow batch lie in one byte buffer; words, hashes and shingles are
found on that buffer with numpy, some megabytes at a time, so no Python string is made
and memory does not depend on the size of a partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
#: Longer words are told apart by a digest: modulo a power of two, a polynomial hash can
#: be the same for long strings that are built alike, whatever its base.
LONG_WORD = 32
U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x + _ODD
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _table(fold_case: bool) -> np.ndarray:
    codes = np.arange(256, dtype=U)
    if fold_case:
        codes[65:91] += U(32)
    return mix(codes + U(1))


TABLES = {fold: _table(fold) for fold in (False, True)}
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters, digits and every byte of a character beyond ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=U)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U(pow(base, done, 1 << 64))
        done += step
    return out


_CACHE: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for texts of ordinary length."""
    if n > 2 * CHUNK_BYTES:
        return _powers(n, _BASE), _powers(n, _INVERSE)
    if "up" not in _CACHE or len(_CACHE["up"]) < n:
        _CACHE["up"], _CACHE["down"] = _powers(n, _BASE), _powers(n, _INVERSE)
    return _CACHE["up"][:n], _CACHE["down"][:n]


def prefix_hash(data: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Prefix sums of a polynomial hash: n + 1 values."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(TABLES[fold_case][data] * up, out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, whatever its place."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if n else data[:0], offsets - offsets[0] if n else np.zeros(1, np.int64)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first row, end row, bytes, offsets)."""
    data, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in the class ``inside``, none across texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    within = inside[data]
    begins = within.copy()
    begins[1:] &= ~within[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = within[heads]
    stops = within.copy()
    stops[:-1] &= ~within[1:]
    stops[heads[1:] - 1] = within[heads[1:] - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of bytes in the class ``inside``."""
    starts, ends = spans(data, offsets, inside)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def by_value(values: np.ndarray, bits: int) -> np.ndarray:
    """Order of whole numbers below 2**bits, equal ones as they come; 16 bits at a time, which numpy sorts in linear time."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    for low in range(16, bits, 16):
        order = order[np.argsort((values[order] >> low & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; offsets count values."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, fold_case: bool, inside: np.ndarray | None = None, digest_long: bool = False
):
    """Hashes of all words and their count offsets per text."""
    starts, ends, text = words(data, offsets, ~SPACE if inside is None else inside)
    hashes = span_hash(prefix_hash(data, fold_case), starts, ends) if len(starts) else np.zeros(0, U)
    if digest_long:
        for i in np.flatnonzero(ends - starts >= LONG_WORD):
            word = data[starts[i] : ends[i]].tobytes()
            hashes[i] = digest(word.lower() if fold_case else word)  # bytes fold ASCII only
    counts = np.bincount(text, minlength=len(offsets) - 1)
    return hashes, np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles of each text, as hashes, and offsets per text.

    A text with fewer than k words, but some, has one shingle: all its words.
    """
    hashes, at = word_hashes(data, offsets, fold_case, digest_long=True)
    n = np.diff(at)
    out_n = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out_at = np.concatenate([[0], np.cumsum(out_n)])
    out = np.zeros(out_at[-1], dtype=U)
    weights = mix(np.arange(1, k + 1, dtype=U)) | U(1)
    if len(hashes) >= k:
        total = hashes[: len(hashes) - k + 1] * weights[0]
        for j in range(1, k):
            total = total + hashes[j : len(hashes) - k + 1 + j] * weights[j]
        text = np.repeat(np.arange(len(n)), n)
        whole = text[: len(total)] == text[k - 1 :]
        long = np.repeat(n >= k, out_n)
        out[long] = mix(total[whole])
    for i in np.flatnonzero((n > 0) & (n < k)):
        seq = hashes[at[i] : at[i + 1]]
        out[out_at[i]] = mix(np.array([(seq * weights[: len(seq)]).sum(dtype=U) + U(len(seq))], dtype=U))[0]
    for i in range(len(n)):
        out[out_at[i] : out_at[i + 1]].sort()
    text = np.repeat(np.arange(len(n)), out_n)
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=len(n))
    return out[new], np.concatenate([[0], np.cumsum(counts)])
