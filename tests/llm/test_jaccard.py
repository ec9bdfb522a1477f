"""The join against brute force over all pairs of sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from musterroll.llm import graph, jaccard, kernels

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, k=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, percent=75):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    posts = {}
    for i, s in enumerate(sets):
        for x in s:
            posts.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in posts[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def check(docs):
    got = sorted((tuple(r) for r in jaccard.jaccard_join(docs).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    return got


def test_sample(sample_docs):
    got = check(sample_docs)
    assert sum(d != c for d, _, c in got) > 5


def near_copies(seed=3):
    """Short and long sets at, above and below the threshold, with a passage in common."""
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(900)
    passage = [word() for _ in range(40)]
    texts = []
    for length in [1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 19, 22, 28, 40, 90, 300]:
        for _ in range(3):
            base = [word() for _ in range(length)]
            texts.append(base)
            for edits in range(1, 6):
                copy = list(base)
                for _ in range(edits):
                    at = rnd.randrange(len(copy) + 1)
                    if rnd.random() < 0.4:
                        copy.insert(at, word())
                    elif rnd.random() < 0.5 and len(copy) > 1:
                        del copy[min(at, len(copy) - 1)]
                    else:
                        copy.append(word())
                texts.append(copy)
    for _ in range(60):
        own = [word() for _ in range(rnd.randrange(5, 60))]
        texts.append(own + passage + own[:2])
    chain = [word() for _ in range(60)]
    texts += [chain[i : i + 50] for i in range(0, 10, 2)]
    rnd.shuffle(texts)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("boundary", [None, 0, 14])
def test_thresholds(make_docs, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    texts = near_copies()
    check(make_docs(list(enumerate(texts + texts[:30]))))


def test_edges(make_docs):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (9, None), (8, ""), (7, " \n"), (6, "a"), (5, "A"), (4, "a b c d"), (3, "a B c D"), (3, "a B c D"),
        (None, "null id here with some words"), (2, "null id here with some words"), (1, long), (0, long + " y"),
        (11, "ä Ä words in case"), (12, "Ä Ä words in case"),
    ]
    check(make_docs(rows, node="clash", n="clash", component_id="clash"))
    assert jaccard.jaccard_join(make_docs([]).where("false")).collect() == []


def test_boundary_grows_with_list_length():
    assert [jaccard.choose_boundary(x) for x in (0, 3, 1000)] == sorted(jaccard.choose_boundary(x) for x in (0, 3, 1000))
    assert jaccard.choose_boundary(0) < jaccard.choose_boundary(1000) <= jaccard.LARGEST_LIGHT


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(40)]
    pairs += [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    pairs = [p for p in pairs if p[0] != p[1]]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    root = {x: x for p in pairs for x in p}
    for _ in range(100):
        for u, v in pairs:
            root[u] = root[v] = min(root[u], root[v])
    assert got == root


def test_kernel_words_and_sets_match_a_plain_split():
    texts = ["", "a b", "Ab aB", None, "x\x0by\x0cz \x1c q", "é É é", "one two three four five six", " lead", "tail "]
    column = pa.array(texts * 3)
    for size in (1, 7, 1 << 20):
        got = []
        for _, _, data, offsets in kernels.chunks(column, size):
            hashes, at = kernels.shingle_sets(data, offsets, 2)
            got += [frozenset(hashes[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
        want = [plain_set(t, 2) for t in texts * 3]
        assert [len(s) for s in got] == [len(s) for s in want]
        for i in range(len(got)):
            for j in range(len(got)):
                assert len(got[i] & got[j]) == len(want[i] & want[j])
    assert np.array_equal(kernels.powers(5)[0][:3] * kernels.powers(5)[1][:3], np.ones(3, np.uint64))


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_words_built_alike_are_different_words(make_docs, n):
    """A polynomial hash modulo 2**64 is the same for these pairs, whatever its base."""
    a, b = thue_morse(n), thue_morse(n, "ba")
    rows = [(1, a), (2, b), (3, f"one two three four {a}"), (4, f"one two three four {b}"), (5, a.upper())]
    got = {r["id"]: r["component_id"] for r in jaccard.jaccard_join(make_docs(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    assert jaccard.one_of_each(make_docs(rows)).count() == 4


def test_marks_of_few_texts_are_small_at_the_driver(spark, make_docs, monkeypatch):
    sent, write = [], jaccard.written

    def seen(df, name, *more):
        out = write(df, name, *more)
        if name == "frequent":
            sent.extend(len(r["shared"]) + len(r["frequent"]) for r in out.collect())
        return out

    monkeypatch.setattr(jaccard, "written", seen)
    text = " ".join(f"w{i}" for i in range(40))
    docs = make_docs([(i, text + f" x{i}") for i in range(30)] + [(99, "one of its own in six words")])
    shared, frequent, mean = jaccard.Join(docs, "doc_id", "text", 5, 75).counted()
    assert sum(sent) < 200_000  # the maps have 17 MB
    assert (len(shared), len(frequent)) == (1 << 24, 1 << 20) and mean == 0
    bits = lambda x: int(np.unpackbits(np.frombuffer(x, np.uint8)).sum())
    assert (bits(shared), bits(frequent)) == (36, 36)  # the shingles that all 30 have
