"""Chat formatting: record layouts found by fingerprint, turns marked and masked.

A record's *layout* is the set of its nested field paths, ``[]`` standing for the
elements of an array.  The hash of the sorted paths, its fingerprint, selects a mapping
from a declared table; the mapping says where roles and texts are, and every layout
becomes the same canonical turns (conversation, turn, role, text).  A DataFrame has one
layout, known from its schema; a column of JSON records may mix layouts, and then every
record is fingerprinted.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and roles, ``<``
followed by any number of backslashes and ``|`` gets one more backslash, which reading
takes away again, so no text can close its turn; in roles, backslashes and line breaks
are escaped as well.  The loss mask covers the texts of assistant turns.

Turns are formatted one by one, so a conversation of any length is never held as a
whole; digests of conversations run over turns sorted by (conversation, turn) and keep
one hash state at a time.

Edge cases: a null text is empty; a null role is the empty role; turns with equal numbers
keep the order of role and text; a conversation with a null id is one of its own; other
columns are not read.  A null or blank record and one whose messages are null or an empty
list have no turns; a null field of a record counts as there where its layout needs it,
and is the empty text.  A record of unknown layout or of broken JSON raises an error, or
is set aside on request.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``paths`` are the field paths that every such record has, ``optional`` those it may
    have.  ``turns``: path of an array of messages with the fields ``role`` and ``text``.
    Else ``fields`` lists (role, path) pairs, joined where several share a role in a row.
    ``flat`` layouts hold one turn per row.  ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    flat: bool = False


_SPOKEN = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), flat=True, text="text"),
    Layout("messages", ("messages", "messages[].role", "messages[].content"), ("id", "conv_id"), turns="messages"),
    Layout("conversation list", ("conversations", "conversations[].from", "conversations[].value"), ("id", "conv_id"),
           turns="conversations", role="from", text="value", roles=_SPOKEN),
    Layout("dialog list", ("dialog", "dialog[].speaker", "dialog[].utterance"), ("id", "conv_id"),
           turns="dialog", role="speaker", text="utterance", roles=_SPOKEN),
    Layout("instruction", ("instruction", "output"), ("id", "conv_id", "input", "system"),
           fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt", ("prompt", "completion"), ("id", "conv_id", "system"),
           fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("question", ("question", "answer"), ("id", "conv_id", "context"),
           fields=(("user", "context"), ("user", "question"), ("assistant", "answer"))),
    Layout("nested pair", ("data", "data.user", "data.assistant"), ("id", "conv_id", "data.system"),
           fields=(("system", "data.system"), ("user", "data.user"), ("assistant", "data.assistant"))),
)


# ---------------------------------------------------------------- fingerprints


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def schema_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema."""
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{prefix}[]")
    if not isinstance(schema, T.StructType):
        return []
    out = []
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        out += [path, *schema_paths(field.dataType, path)]
    return out


def record_paths(record, prefix: str = "", nulls: bool = False) -> set[str]:
    """Nested field paths of a parsed JSON record; null fields count on request only."""
    if isinstance(record, list):
        return set().union(*(record_paths(x, f"{prefix}[]", nulls) for x in record)) if record else set()
    if not isinstance(record, dict):
        return set()
    out = set()
    for name, value in record.items():
        if value is not None or nulls:
            path = f"{prefix}.{name}" if prefix else name
            out |= {path} | record_paths(value, path, nulls)
    return out


def registry(layouts: Iterable[Layout] = LAYOUTS) -> dict[str, Layout]:
    """Fingerprints of all forms of the layouts: required paths with any optional ones."""
    out: dict[str, Layout] = {}
    for layout in layouts:
        for chosen in range(1 << len(layout.optional)):
            extra = [p for i, p in enumerate(layout.optional) if chosen >> i & 1]
            if out.setdefault(fingerprint([*layout.paths, *extra]), layout) is not layout:
                raise ValueError(f"layouts {out[fingerprint([*layout.paths, *extra])].name!r} and {layout.name!r} overlap")
    return out


def layout_of(paths: Iterable[str], known: Mapping[str, Layout]) -> Layout | None:
    """By the fingerprint of all paths, else of those that some layout names."""
    paths = set(paths)
    found = known.get(fingerprint(paths))
    if found is None:
        named = {p for x in set(known.values()) for p in (*x.paths, *x.optional)}
        found = known.get(fingerprint(paths & named))
    return found


def layout_of_record(record, known: Mapping[str, Layout]) -> Layout | None:
    """Layout of a parsed record: by its filled fields, else by all it names.

    A record whose list of messages is null or holds none has the layout of that list.
    """
    if not isinstance(record, dict):
        return None
    found = layout_of(record_paths(record), known)
    named = record_paths(record, nulls=True)
    if found is None:
        found = layout_of(named, known)
    if found is None:
        for layout in dict.fromkeys(known.values()):
            if layout.turns not in named:
                continue
            held = _pick(record, layout.turns)
            if held is None or isinstance(held, list) and not any(held):
                return layout_of(named | set(layout.paths), known)
    return found


# ---------------------------------------------------------------- canonical turns


def _pick(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """Canonical (role, text) turns of one parsed record."""
    names = dict(layout.roles)
    if layout.flat:
        found = [(record.get(layout.role), record.get(layout.text))]
    elif layout.turns:
        found = [(x.get(layout.role), x.get(layout.text)) for x in _pick(record, layout.turns) or () if isinstance(x, dict)]
    else:
        found = []
        for role, path in layout.fields:
            value = _pick(record, path)
            if value is None or value == "" and role != LEARNED:
                continue
            if found and found[-1][0] == role:
                found[-1] = (role, f"{found[-1][1]}\n\n{_text(value)}")
            else:
                found.append((role, _text(value)))
    return [(names.get(_text(r), _text(r)), _text(x)) for r, x in found]


def canonical_turns(
    records: DataFrame, layouts: Iterable[Layout] = LAYOUTS, record: str | None = None, id: str = "conv_id",
    set_aside: bool = False,
) -> DataFrame:
    """(conv_id, turn, role, text) of records in any declared layout.

    With ``record``, that column holds JSON records of mixed layouts and ``id`` names
    their conversations; else the schema of ``records`` is the layout.  Records of unknown
    layout raise an error; with ``set_aside`` they become one turn of role ``unknown``.
    """
    known = registry(layouts)
    if record is None:
        layout = layout_of(schema_paths(records.schema), known)
        if layout is None:
            raise ValueError(f"no layout has the paths {sorted(schema_paths(records.schema))}")
        if layout.flat:
            return records.select(
                F.col(id).alias("conv_id"),
                F.col("turn").cast("bigint").alias("turn"),
                _renamed(F.coalesce(F.col(layout.role), F.lit("")), layout).alias("role"),
                F.coalesce(F.col(layout.text), F.lit("")).alias("text"),
            )
        records = records.select(F.col(id), F.to_json(F.struct("*")).alias("_record"))
        record = "_record"
    kind = records.schema[id].dataType.simpleString()

    def convert(batches):
        for batch in batches:
            ids, turns, roles, texts = [], [], [], []
            for i, line in enumerate(batch.column(1).to_pylist()):
                if line is None or not line.strip():
                    continue
                try:
                    parsed = json.loads(line)
                except ValueError:
                    parsed = None
                layout = layout_of_record(parsed, known)
                if layout is not None:
                    found = turns_of(parsed, layout)
                elif set_aside:
                    found = [("unknown", line)]
                else:
                    raise ValueError(f"no layout has the paths {sorted(record_paths(parsed))}")
                first = parsed.get("turn") or 0 if layout is not None and layout.flat else 0
                for k, (role, text) in enumerate(found):
                    ids.append(i)
                    turns.append(first + k)
                    roles.append(role)
                    texts.append(text)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(turns, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())],
                names=["conv_id", "turn", "role", "text"],
            )

    picked = records.select(F.col(id).alias("conv_id"), F.col(record).alias("record"))
    return picked.mapInArrow(convert, f"conv_id {kind}, turn long, role string, text string")


def _renamed(role: Column, layout: Layout) -> Column:
    for old, new in layout.roles:
        role = F.when(role == old, new).otherwise(role)
    return role


# ---------------------------------------------------------------- template


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def formatted_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end): each turn as the template has it.

    Loss places are code points in ``formatted``, null for turns that are not learned.
    """
    role = _escaped(F.replace(F.replace(F.col("role"), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = _escaped(F.col("text"))
    learned = F.col("role") == LEARNED
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit(f"{END}\n")).alias("formatted"),
        F.when(learned, F.length(head)).cast("bigint").alias("loss_start"),
        F.when(learned, F.length(head) + F.length(body)).cast("bigint").alias("loss_end"),
    )


_ESCAPE = re.compile(r"<(\\*)\\\|")
_ROLE_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"<\1|", text)


def unescape_role(text: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Turns (role, text) of formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at place {at}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, read back from their formatted turns.

    Turns are sorted by conversation and number and streamed: a task keeps the hash
    states of one conversation.  A hash over a whole conversation needs its turns in one
    task; how long it is costs time there, but no memory.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches):
        state, done, types = None, [], None

        def close():
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flush():
            columns = list(zip(*done, strict=True)) if done else [[] for _ in names]
            arrays = [pa.array(columns[0], types)] + [pa.array(c, pa.string() if "sha" in n else pa.int64()) for c, n in zip(columns[1:], names[1:], strict=True)]
            done.clear()
            return pa.record_batch(arrays, names=names)

        for batch in batches:
            types = batch.schema.field("conv_id").type
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, piece, lo, hi in zip(*columns, strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if lo is not None:
                    learned = unescape(piece[lo:hi])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(piece)
            if done:
                yield flush()
        if state is not None:
            close()
            yield flush()

    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return dealt.mapInArrow(digest, schema)


def whole_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted): each conversation as one text, for conversations of readable size."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "formatted")))
    return formatted.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["formatted"]), "").alias("formatted"))
