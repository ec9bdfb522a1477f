"""Suffix arrays and the dedup against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from musterroll.llm import suffixes


@given(st.text("ab", max_size=60) | st.text("abcdz", max_size=60))
@settings(max_examples=200, deadline=None)
def test_suffix_array(text):
    s = np.array([ord(c) - 96 for c in text] + [0], np.int16)
    got = suffixes.suffix_array(s).tolist()
    assert got == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    shared = suffixes.common_prefixes(s, np.array(got), 7)
    for a, b in zip(got, got[1:], strict=False):
        n = 0
        while n < 7 and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        assert shared[b] == n


def brute_starts(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    return [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in texts]


@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_repeated_starts(texts, length):
    got = suffixes.repeated_starts([np.frombuffer(t, np.uint8) for t in texts], length)
    assert [x.tolist() for x in got] == brute_starts(texts, length)


@given(st.lists(st.integers(0, 2), max_size=50), st.integers(1, 9))
@settings(deadline=None)
def test_sliding_minimum(values, width):
    got = suffixes.sliding_minimum(np.array(values, np.uint64), width)
    assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, starts in zip(rows, texts, brute_starts(texts, length), strict=True):
        gone = set()
        for i in starts:
            gone.update(range(i, i + length))
        kept = bytes(b for i, b in enumerate(t) if i not in gone)
        runs = sum(i - 1 not in gone for i in gone)
        out.append((d, len(t), len(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(docs, length):
    got = suffixes.suffix_dedup(docs, length=length).collect()
    assert sorted(((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == brute(
        [(r["doc_id"], r["text"]) for r in docs.collect()], length
    )
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in got:
        runs = np.frombuffer(r["spans"], np.int64).reshape(-1, 2)
        if r["n_spans"] and r["id"] is not None:
            t = texts[r["id"]]
            assert r["kept"] == b"".join(t[a:b] for a, b in zip([0, *runs[:, 1]], [*runs[:, 0], len(t)], strict=True))
    return got


def test_sample(sample_docs):
    assert any(r["n_spans"] for r in check(sample_docs, 200))


@pytest.mark.parametrize("length", [8, 40, 200])
def test_planted(make_docs, length):
    rnd = random.Random(length)
    text = lambda n: "".join(rnd.choice("abcdefgh é\n") for _ in range(n))
    shared, twice = text(3 * length), text(length + 1)
    rows = [(i, text(rnd.randrange(6 * length))) for i in range(30)]
    rows += [(100 + i, text(50) + shared[i : 3 * length - i] + text(9)) for i in range(0, length, max(1, length // 9))]
    rows += [(200, twice + text(30) + twice), (201, shared), (202, shared), (202, shared), (203, "ab" * 3 * length)]
    rows += [(204, "a" * 7 * length), (205, "b" * (length - 1)), (206, "b" * length), (207, "c" * (length + 1))]
    rows += [(300, None), (301, ""), (None, shared[: 2 * length])]
    check(make_docs(rows, key="clash", spans="clash", kept="clash"), length)


def test_segments(make_docs, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 500)
    rnd = random.Random(1)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = [text(300) for _ in range(8)]
    rows = [(i, "".join(text(rnd.randrange(400)) + x for x in rnd.sample(shared, 5))) for i in range(9)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in rows])])
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    pieces = suffixes.fingerprints(data, offsets)
    monkeypatch.setattr(suffixes, "SEGMENT", 1 << 20)
    whole = suffixes.fingerprints(data, offsets)
    chosen = lambda f: {(int(a), int(b), int(c), int(d)) for a, b, c, d in zip(f[0], f[1], f[2], f[3], strict=True)}
    assert chosen(pieces) >= chosen(whole)
    check(make_docs(rows), 200)


def test_crowded(make_docs, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWDED", 3)
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = text(260)
    rows = [(i, text(rnd.randrange(300)) + shared[i % 30 : 260 - i % 7] + text(rnd.randrange(300))) for i in range(40)]
    check(make_docs([*rows, (90, shared), (91, shared[:199]), (92, "z" * 900), (93, shared + shared)]), 200)


def test_empty(make_docs):
    assert suffixes.suffix_dedup(make_docs([]).where("false")).collect() == []


def test_texts_built_alike_have_different_keys():
    def word(n, letters):
        return "".join(letters[i.bit_count() & 1] for i in range(n)).encode()

    for n in (1024, 2048, 4096):
        texts = [word(n, "ab"), word(n, "ba")]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.array([0, n, 2 * n])
        a, b = suffixes.text_keys(data, offsets)
        assert a != b


def test_memory_of_fingerprints_does_not_follow_the_chunk():
    data = np.random.default_rng(5).integers(97, 123, 2 << 20).astype(np.uint8)
    offsets = np.arange(0, len(data) + 1, 4096)
    suffixes.fingerprints(data, offsets)  # powers are kept
    tracemalloc.start()
    found = suffixes.fingerprints(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) > 10_000 and peak < 50e6  # 139 MB in one segment
