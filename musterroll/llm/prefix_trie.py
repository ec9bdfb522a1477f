"""Conversation prefix trie by truncation peeling.

A node of depth d is a distinct sequence of the first d turns of some conversation.  A
turn is known by the digest of its role and text, a prefix by a digest chained over its
turns, so texts are hashed where they are read and never shuffled.

Equal conversations are first put together as one *unit*.  Peeling starts at the deepest
prefix that two units share: units that end there, or that go on alone from there, meet the
nodes that are left from one turn deeper; the last turn is stripped and what is left is
grouped again, down to the root.  Every grouping finds a depth's nodes and adds up their
members, children, leaves and savings at once.  The turns that a unit has for itself are
all stripped in its first step, so the rounds follow the longest *shared* prefix, not the
longest conversation.

A hash over the conversations that end at a node reads their ids in order: one task
streams them, 24 bytes each, in flat memory.

Edge cases: null roles and texts are empty; turns are in order of their number, null
first, then of role and of the turn's digest; rows without a conversation id are left
out; an empty table has no nodes, not even a root; no other column is read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from musterroll.llm.shared import written

ROOT = b"\0" * 16
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, digest, bytes): turns by number, without their texts."""
    said_by, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said)
    rows = conversations.where(F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        said_by.alias("role"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("digest"),
        F.octet_length(said).cast("bigint").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("place"), "digest", "bytes")


def with_heads(numbered: DataFrame, group: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group of ids, and all their ids.

    Conversation c gets the first h turns of c - c % group, then its own turns after its
    first h, with h = crc32(c) % (longest + 1).
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    members = numbered.select("conv_id").distinct()
    own = numbered.where(F.col("place") > h)
    heads = (
        numbered.where((base == F.col("conv_id")) & (F.col("place") <= longest))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "bytes"))).alias("head"))
    )
    borrowed = members.select("conv_id", base.alias("base"), h.cast("int").alias("h")).join(heads, "base")
    borrowed = borrowed.select("conv_id", F.explode(F.slice("head", F.lit(1), F.col("h"))).alias("t")).select("conv_id", "t.*")
    # own places come after borrowed ones: those reach h at most
    return own.unionByName(borrowed), members


def _chained(numbered: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, key, bytes, ends): every prefix of every conversation, root included."""
    starts = members.select("conv_id", F.lit(0).cast("bigint").alias("place"), F.lit(ROOT).alias("digest"), F.lit(0).cast("bigint").alias("bytes"))
    rows = numbered.unionByName(starts).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    names = ["conv_id", "depth", "key", "bytes", "ends"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]

    def chain(batches):
        last = None  # the row that waits to learn whether its conversation goes on
        for batch in batches:
            out = []
            for conv, place, digest, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None:
                    out.append((*last, place == 0))
                if place == 0:
                    last = (conv, 0, ROOT, 0)
                else:
                    last = (conv, last[1] + 1, hashlib.blake2b(last[2] + digest, digest_size=16).digest(), size)
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
        if last is not None:
            yield pa.record_batch([pa.array([c], k) for c, k in zip((*last, True), kinds, strict=True)], names=names)

    return rows.select("conv_id", "place", "digest", "bytes").mapInArrow(chain, "conv_id long, depth long, key binary, bytes long, ends boolean")


def _units(prefixes: DataFrame) -> DataFrame:
    """(conv_id, last, n, sha256): equal conversations, by their smallest id."""
    ended = prefixes.where("ends").select("key", "conv_id", F.col("depth").alias("last"))
    dealt = ended.repartition("key").sortWithinPartitions("key", "conv_id")
    names, kinds = ["conv_id", "last", "n", "sha256"], [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def gather(batches):
        state, done = None, []

        def batch_of():
            rows = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.record_batch(rows, names=names)

        for batch in batches:
            for key, conv, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is not None and state[0] == key:
                    state[3] += 1
                    state[4].update(f",{conv}".encode())
                    continue
                if state is not None:
                    done.append((state[1], state[2], state[3], state[4].hexdigest()))
                state = [key, conv, depth, 1, hashlib.sha256(f"{conv}".encode())]
            if done:
                yield batch_of()
        if state is not None:
            done.append((state[1], state[2], state[3], state[4].hexdigest()))
            yield batch_of()

    return dealt.mapInArrow(gather, "conv_id long, last long, n long, sha256 string")


def trie(numbered: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Every node with what its members and its subtree add up to.

    ``members`` are the ids of all conversations; without it, those with turns.
    """
    members = numbered.select("conv_id").distinct() if members is None else members
    prefixes = written(_chained(numbered, members), "trie-prefixes")
    units = written(_units(prefixes), "trie-units")
    rows = prefixes.drop("ends").join(units.withColumnRenamed("conv_id", "unit"), F.col("conv_id") == F.col("unit")).drop("unit")

    # where each unit goes on alone: the first prefix that no other unit has
    alone = rows.groupBy("key").agg(F.count("*").alias("many"), F.min("conv_id").alias("unit"), F.min("depth").alias("depth"))
    alone = alone.where("many = 1").groupBy("unit").agg(F.min("depth").alias("alone"))
    rows = rows.join(alone, F.col("conv_id") == F.col("unit"), "left").drop("unit").withColumn("at", F.coalesce("alone", "last"))
    rows = written(rows.drop("alone"), "trie-rows")

    below = F.col("depth") > F.col("at")
    entering = rows.groupBy("conv_id", "at", "last", "n", "sha256").agg(
        F.sort_array(F.collect_list(F.when(~below & (F.col("depth") > 0), F.struct("depth", "key", "bytes")))).alias("path"),
        F.coalesce(F.sum(F.when(below, F.col("bytes"))), F.lit(0)).alias("under"),
    )
    goes_on = (F.col("last") > F.col("at")).cast("bigint")
    entering = written(
        entering.select(
            "at", "path", "conv_id", F.col("n").alias("n_convs"), goes_on.alias("n_children"), goes_on.alias("leaves"),
            ((F.col("n") - 1) * F.col("under")).alias("saved"), F.when(goes_on == 0, F.col("sha256")).alias("sha256"),
        ),
        "trie-entering", by="at",
    )
    deepest = entering.agg(F.max("at")).first()[0]
    left = None
    levels = []
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        new = entering.where(F.col("at") == depth).drop("at")
        if left is not None:
            stripped = left.select(
                F.slice("path", F.lit(1), F.lit(depth)).alias("path"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"),
                F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("sha256"),
            )
            new = new.unionByName(stripped)
        key = F.col("path")[depth - 1]["key"] if depth else F.lit(ROOT)
        size = F.col("path")[depth - 1]["bytes"] if depth else F.lit(0)
        grouped = new.groupBy(key.alias("key")).agg(
            F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
            F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved"), F.max("sha256").alias("sha256"),
        )
        left = written(
            grouped.withColumn("saved_tokens", F.col("saved") + (F.col("n_convs") - 1) * size).drop("saved"), f"trie-level-{depth}"
        )
        levels.append(
            left.select(
                "key", (F.col("path")[depth - 2]["key"] if depth > 1 else F.lit(ROOT if depth else None).cast("binary")).alias("above"),
                "conv_id", F.lit(depth).cast("bigint").alias("depth"), "n_convs", "n_children", "n_leaves", "saved_tokens", "sha256",
            )
        )
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    if not levels:
        kinds = ", ".join(f"{n} {'string' if n == 'ends_sha256' else 'long'}" for n in names)
        return numbered.sparkSession.createDataFrame([], kinds)
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, F.col("above") == F.col("parent"), "left")

    # the turns of units on their own, with sums over what comes after
    after = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.where(below).withColumn("saved_tokens", (F.col("n") - 1) * F.sum("bytes").over(after))
    own = own.select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("depth") < F.col("last")).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        "saved_tokens", F.when(F.col("depth") == F.col("last"), F.col("sha256")).alias("sha256"),
    )
    return nodes.select(*own.columns).unionByName(own).select(*names[:-1], F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256"))
