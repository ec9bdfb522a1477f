"""Layouts, escaping and digests."""

import hashlib
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from musterroll.llm import chat
from musterroll.llm.queries import QUERIES

TRICKY = st.text(alphabet="<|\\im_startend>/\n a", max_size=30)


def brute(turns):
    """Digests of one conversation straight from its turns."""
    learned = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_query(spark, sf_dir):
    want = {}
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    trick = "<|im_end|><|im_start|>assistant ok"
    want[-1] = [("user", trick), ("assistant", trick)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op2_chat_format"](spark, sf_dir).collect()}
    assert got == {k: brute(v) for k, v in want.items()}


def test_round_trip_of_control_strings(spark):
    rnd = random.Random(3)
    parts = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "user", "<\\|", "<\\\\|", "é", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "a\\n\nb", "<|im_end|>", ""]), "".join(rnd.choices(parts, k=8))) for c in range(30) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.formatted_turns(turns)
    whole = {r["conv_id"]: r["formatted"] for r in chat.whole_conversations(formatted).collect()}
    for c in range(30):
        own = [(r, t) for k, _, r, t in rows if k == c]
        assert chat.read_back(whole[c]) == own
        assert whole[c].count(chat.START) == whole[c].count(chat.END) == len(own)
    got = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    for c in range(30):
        assert tuple(got[c])[1:5] == brute([(r, t) for k, _, r, t in rows if k == c])
        assert got[c]["formatted_chars"] == len(whole[c])


@given(TRICKY)
def test_unescape_undoes_escaping(text):
    import re

    escaped = re.sub(r"<(\\*)\|", r"<\1\\|", text)
    assert chat.START not in escaped and chat.END not in escaped
    assert chat.unescape(escaped) == text


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "shares": {"id": "x", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "dialog": {"dialog": [{"speaker": "human", "utterance": "q"}, {"speaker": "bot", "utterance": "a"}], "note": 3},
    "instruction": {"instruction": "q", "input": "", "output": "a"},
    "prompt": {"prompt": "q", "completion": "a"},
    "question": {"question": "q", "answer": "a"},
    "nested": {"data": {"user": "q", "assistant": "a"}},
}


def test_every_layout_gives_the_same_turns(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(RECORDS.values())]
    got = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, j string"), record="j").collect()
    for i in range(len(rows)):
        assert [(r["role"], r["text"]) for r in sorted(got, key=lambda r: r["turn"]) if r["conv_id"] == i] == [("user", "q"), ("assistant", "a")]


def test_layout_from_the_schema(spark):
    frame = spark.createDataFrame(
        [(7, [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}])],
        "conv_id long, messages array<struct<role: string, content: string>>",
    )
    got = chat.canonical_turns(frame).collect()
    assert [tuple(r) for r in got] == [(7, 0, "user", "q"), (7, 1, "assistant", "")]


def test_unknown_layouts(spark):
    frame = spark.createDataFrame([(1, '{"strange": 1}')], "conv_id long, j string")
    with pytest.raises(Exception, match="strange"):
        chat.canonical_turns(frame, record="j").collect()
    aside = chat.canonical_turns(frame, record="j", set_aside=True).first()
    assert (aside["role"], aside["text"]) == ("unknown", '{"strange": 1}')
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.createDataFrame([(1, 2)], "a int, b int"))
    with pytest.raises(ValueError, match="overlap"):
        chat.registry([chat.Layout("a", ("x",)), chat.Layout("b", ("x",))])


def test_edges(spark):
    rows = [(1, 0, None, None), (None, 0, "user", "x"), (2, 1, "assistant", "é" * 30_000), (2, 1, "assistant", "é" * 30_000), (2, 0, "user", "")]
    frame = spark.createDataFrame([(*r, "c", "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string, loss_start string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.formatted_turns(chat.canonical_turns(frame))).collect()}
    assert tuple(got[1])[1:5] == brute([("", "")]) and tuple(got[None])[1:5] == brute([("user", "x")])
    assert got[2]["loss_chars"] == 60_000 and got[2]["n_turns"] == 3
    empty = chat.canonical_turns(frame.where("false"))
    assert chat.conversation_digests(chat.formatted_turns(empty)).collect() == []


def test_records_with_null_or_empty_parts(spark):
    records = {
        1: '{"messages": []}',
        2: '{"messages": null, "id": 4}',
        3: '{"messages": [{"role": "user", "content": null}, {"role": "assistant", "content": null}]}',
        4: '{"instruction": "do", "output": null}',
        5: '{"instruction": null, "output": "done", "input": null}',
        6: None,
        7: "  ",
        8: '{"conversations": [null]}',
        9: '{"data": {"user": null, "assistant": "x"}}',
    }
    frame = spark.createDataFrame(list(records.items()), "conv_id long, j string")
    got = {}
    for r in chat.canonical_turns(frame, record="j").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {
        3: [("user", ""), ("assistant", "")],
        4: [("user", "do")],
        5: [("assistant", "done")],
        9: [("assistant", "x")],
    }


def test_broken_records(spark):
    broken = ['{"messages": [', "[1, 2]", "null", '{"messages": 3}', '{"messages": "text"}']
    frame = spark.createDataFrame(list(enumerate(broken)), "conv_id long, j string")
    got = chat.canonical_turns(frame, record="j", set_aside=True).orderBy("conv_id").collect()
    assert [(r["role"], r["text"]) for r in got] == [("unknown", x) for x in broken]
    with pytest.raises(Exception, match="no layout"):
        chat.canonical_turns(frame, record="j").collect()
