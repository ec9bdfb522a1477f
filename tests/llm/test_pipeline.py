"""Every stage of the pipeline against a plain version, on the stage's own input."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from test_jaccard import brute as brute_groups

from musterroll.llm import mixing, toxicity
from musterroll.llm.shared import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output rows of every stage."""
    docs = table(spark, sf_dir, "documents")
    seen = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        seen[name] = docs.collect()
        assert docs.columns[:5] == COLUMNS
    return seen


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_toxicity(spark, sf_dir, stages):
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).collect()
    assert ids(stages["toxicity"]) == sorted(r["id"] for r in scores if not r["predicted"])


def test_near_duplicates(stages):
    groups = brute_groups([(r["doc_id"], r["text"]) for r in stages["toxicity"]])
    assert ids(stages["near_duplicates"]) == sorted(d for d, _, c in groups if d == c)


def test_decontamination(spark, sf_dir, stages):
    plain = lambda s: " " + " ".join(re.findall(r"\w+", (s or "").lower())) + " "
    items = [plain(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    want = sorted(r["doc_id"] for r in stages["near_duplicates"] if not any(i in plain(r["text"]) for i in items))
    assert ids(stages["decontamination"]) == want


def test_mixing(stages):
    """At the end of the mix every source is less than one block away from its share."""
    have = Counter(r["source"] for r in stages["decontamination"])
    took = Counter(r["source"] for r in stages["mixing"])
    weights = mixing.target_weights({f"+{s}": n for s, n in have.items()})
    blocks = {s: -(-n // mixing.BLOCK_ROWS) for s, n in took.items()}
    slots, total = sum(blocks.values()), sum(weights.values())
    assert all(abs(blocks.get(s, 0) - slots * weights[f"+{s}"] / total) < 1 for s in have)
    assert any(took[s] == have[s] for s in have) and all(took[s] <= have[s] for s in have)
    assert set(ids(stages["mixing"])) <= set(ids(stages["decontamination"]))


def test_mixing_keeps_every_row(spark, sf_dir, stages, make_docs):
    assert ids(stages["mixing"]) == ids(stages["decontamination"])
    for name in ("mixing", "sharding"):
        assert sorted(r["position"] for r in stages[name]) == list(range(len(stages["decontamination"])))
    # a source of one block cuts nothing off, nor does a column of the input
    docs = make_docs([(i, "t", "rare" if i < 3 else "ab"[i % 2]) for i in range(2000)])
    rows = corpus_pipeline.mixed(spark, docs.withColumn("position", docs["doc_id"] * 0), sf_dir).collect()
    assert ids(rows) == list(range(2000))
    assert sorted(r["position"] for r in rows) == list(range(2000))
    assert {r["phase"] for r in rows} > {0}


def test_sharding(stages):
    sizes = Counter(r["shard"] for r in stages["sharding"])
    assert ids(stages["sharding"]) == ids(stages["mixing"])
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1


def test_equal_rows_and_null_ids(spark, make_docs):
    from musterroll.llm.jaccard import one_of_each

    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text here"), (2, "a b c d e f"), (None, "a b c d e f"),
            (None, "only null ids"), (None, "only null ids"), (3, ""), (4, None), (3, "")]
    got = one_of_each(make_docs(rows, _node="c")).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted(
        [("1", "a b c d e f"), ("1", "other text here"), ("None", "only null ids"), ("3", ""), ("3", ""), ("4", "None")]
    )
    assert one_of_each(make_docs([]).where("false")).collect() == []
