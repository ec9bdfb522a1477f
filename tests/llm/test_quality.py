"""Quality counts against a plain reading of their definitions."""

import re
from collections import Counter

import pytest

from musterroll.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def check(docs):
    rows = quality.quality_rules(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert tuple(r[c] for c in COLUMNS) == want, r["doc_id"]
        n, _, _, _, repeats = want
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    return rows


def test_sample(sample_docs):
    rows = check(sample_docs)
    assert 0.3 < sum(r["kept"] for r in rows) / len(rows) < 1


def test_edges(make_docs):
    texts = [
        None, "", " ", "\n\n", "a", "a b", "a b a b a b", "x y z", " \x0b\x0c\r\t lead", "a a a a a a",
        "one two three four one two three", "l\nl\nl \nl", "é ü 漢字 # * $", "\x00 \x1c\x1d b",
        "w " * 5000, " ".join(f"w{i % 997}" for i in range(6000)),
    ]
    check(make_docs(list(enumerate(texts)), n_words="clash", kept="clash", h="clash"))


def test_very_long_text(make_docs, monkeypatch):
    monkeypatch.setattr(quality, "PACKED_WORDS", 8)
    check(make_docs([(1, "a b c d a b c " * 300), (2, " ".join(map(str, range(900))) + " 0 1 2")]))


def test_empty_table(make_docs):
    assert quality.quality_rules(make_docs([]).where("false")).collect() == []


@pytest.mark.parametrize("bad", ["| ".join("word" for _ in range(90)), "xx yy zz qq. " * 40])
def test_junk_goes(make_docs, bad):
    assert not quality.quality_rules(make_docs([(1, bad)])).first()["kept"]


def test_clean_prose_stays(make_docs):
    prose = "the harbour of the town was quiet in the morning and that suited everyone who worked " \
        "there because the boats came back before noon with fish for the market while children " \
        "watched from a wall near the old church until the bells rang and they ran to school " \
        "along a narrow lane between gardens"
    assert quality.quality_rules(make_docs([(1, prose)])).first()["kept"]
