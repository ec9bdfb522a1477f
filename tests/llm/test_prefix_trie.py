"""The trie against one built turn by turn, with copies, ties, gaps and long conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import oracle
import pytest

from musterroll.llm import ORACLES, QUERIES, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, key string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(conversations):
    """Nodes of {conversation: [(role, text), ...]}, one prefix at a time."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, path in conversations.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    rows = []
    for p in members:
        under = [q for q in members if q[: len(p)] == p]
        rows.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
            sum(len(q) == len(p) + 1 for q in under),
            sum(not any(len(z) == len(q) + 1 and z[:-1] == q for z in members) for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def table(spark, conversations):
    rows = [(c, i, r, t, 1, "k") for c, path in conversations.items() for i, (r, t) in enumerate(path)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def rebuilt(conversations):
    out = {}
    for c, path in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + path[h:]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_tree(spark, seed):
    draw = random.Random(seed)
    conversations = {
        draw.randrange(10**6): [(draw.choice(["user", "a"]), draw.choice(["", "x", "yé", "zz"])) for _ in range(draw.randrange(1, 7))]
        for _ in range(60)
    }
    assert got(prefix_trie.trie(prefix_trie.turns(table(spark, conversations)))) == plain(conversations)


def test_rebuilt_conversations(spark):
    draw = random.Random(5)
    ids = [c for c in range(60) if c % 7] + [10**12 + 1]  # some groups lack their first
    conversations = {c: [("user", draw.choice("abc")) for _ in range(draw.randrange(1, 12))] for c in ids}
    numbered, members = prefix_trie.with_heads(prefix_trie.turns(table(spark, conversations)))
    assert got(prefix_trie.trie(numbered, members)) == plain(rebuilt(conversations))


def test_copies_and_long_tails(spark):
    long = [("user", f"t{i}") for i in range(3000)]
    conversations = {c: [("user", "hi"), ("a", "yo")] for c in range(40)}
    conversations |= {50: long, 51: long, 52: [("user", "hi")], 53: [("user", "hi"), ("a", "yo"), ("user", "bye")]}
    nodes = got(prefix_trie.trie(prefix_trie.turns(table(spark, conversations))))
    assert len(nodes) == 1 + 3 + 3000
    by = {(r[0], r[1]): r for r in nodes}
    assert by[0, 0][3:6] == (44, 2, 2) and by[0, 2][3:6] == (41, 1, 1) and by[50, 3000][2:6] == (50, 2, 0, 1)
    assert by[50, 1][6] == sum(len(t) for _, t in long) and by[50, 2999][6] == len("t2998") + len("t2999")
    assert by[0, 1][7] == hashlib.sha256(b"52").hexdigest()


def test_ties_and_nulls(spark):
    rows = [(1, None, None, None), (1, 0, "a", "x"), (1, 0, "a", "x"), (2, 5, "", ""), (2, 9, "a", "x"), (2, 9, "a", "x"), (None, 0, "a", "b")]
    data = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA)
    same = [("", ""), ("a", "x"), ("a", "x")]
    assert got(prefix_trie.trie(prefix_trie.turns(data))) == plain({1: same, 2: same})
    assert prefix_trie.trie(prefix_trie.turns(data.limit(0))).collect() == []
    assert prefix_trie.trie(prefix_trie.turns(data.limit(0))).columns == NAMES


def test_conversations_without_turns(spark):
    # 11 takes its first turns from the absent 10 and has none of its own beyond them
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(200)}
    c = next(c for c in range(11, 200) if c % 5 and h[c] > 0)
    numbered, members = prefix_trie.with_heads(prefix_trie.turns(table(spark, {c: [("user", "x")]})))
    assert got(prefix_trie.trie(numbered, members)) == plain({c: []})


def test_query_matches_sql(spark, sf_dir):
    assert oracle.compare(QUERIES["op12_prefix_trie"](spark, sf_dir), ORACLES["op12_prefix_trie"], oracle.connect(sf_dir)) is None
