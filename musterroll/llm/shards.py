"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a row belongs to the first point clockwise of
its key's hash.  A shard takes no more than its bound; rows that find it full go on
clockwise to the next point whose shard has room.  With the tight bounds used here
(whole division of the rows) shard sizes differ by at most one, and a row moves only
as far as it must.

At scale the ring is worked out on counts: rows per arc are counted in Spark, the walk
over the arcs (a fixed number, whatever the data) says which ranks of an arc go to
which shard, and rows find their place by their rank inside the arc.  No shard or arc
boundary is computed from collected rows.

Edge cases: null text has size 1 and checksum 0; a null key has its own place on the
ring; equal rows are placed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import xxhash

from musterroll.llm.shared import longs

SHARDS, VIRTUAL_NODES = 16, 64
CELL_BITS = 12
LAW = "rows"


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Points of the ring, sorted: (place as signed long, shard)."""
    points = [
        (xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    ]
    return sorted(points)


def bounds(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Send the rows of each arc clockwise to shards with room.

    Returns (arc, first rank, end rank, shard, slot of the first rank).  In turn r every
    arc offers what it has left to the point r steps on; as the bounds add up to the
    rows, everything finds a place within one round.
    """
    room, done, slot, out = list(room), [0] * len(counts), [0] * len(room), []
    pending = [a for a, n in enumerate(counts) if n]
    for turn in range(len(counts)):
        for arc in pending:
            shard = owners[(arc + turn) % len(owners)]
            take = min(counts[arc] - done[arc], room[shard])
            if take:
                out.append((arc, done[arc], done[arc] + take, shard, slot[shard]))
                done[arc] += take
                slot[shard] += take
                room[shard] -= take
        pending = [a for a in pending if done[a] < counts[a]]
        if not pending:
            break
    return out


def arc_of(place: Column, points: list[int]) -> Column:
    """Index of the first ring point at or after a place (wrapping round).

    Cells of equal width hold the few points that fall in them, so a look-up costs a few
    comparisons however many points there are.
    """
    width = 64 - CELL_BITS
    starts = [-(1 << 63) + (c << width) for c in range(1 << CELL_BITS)]
    first = longs([bisect_left(points, s) for s in starts])
    inside = ",".join(
        "array(" + ",".join(f"{p}L" for p in points[bisect_left(points, s) : bisect_left(points, s + (1 << width))]) + ")"
        for s in starts
    ).replace("array()", "cast(array() as array<bigint>)").replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    cell = (F.shiftright(place, width) + (1 << (CELL_BITS - 1))).cast("int")
    held = F.get(F.expr(f"array({inside})"), cell)
    before = F.size(F.filter(held, lambda p: p < place))
    return F.pmod(F.get(first, cell) + before, F.lit(len(points))).cast("int")


def ring_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    id: str = "doc_id",
    text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Shard and slot of every row: (id, size, text_crc32, shard, slot, doc).

    ``doc`` is the whole row as a struct with ``carry``, else absent.  Slots count from 0
    in each shard without gaps.
    """
    points = ring(shards, virtual_nodes)
    owners = [s for _, s in points]
    body = F.coalesce(F.col(text), F.lit(""))
    arc = arc_of(F.xxhash64(F.col(id)), [p for p, _ in points])
    found = {
        r["arc"]: r["n"]
        for r in docs.groupBy(arc.alias("arc")).agg(F.count("*").alias("n")).collect()
    }  # one row per arc, so bounded by the ring
    counts = [found.get(a, 0) for a in range(len(points))]
    places = walk(counts, owners, bounds(sum(counts), shards))
    rows = docs.select(
        F.col(id).alias("id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        arc.alias("arc"),
        *([F.struct("*").alias("doc")] if carry else []),
    )
    order = Window.partitionBy("arc").orderBy(F.xxhash64("id"), "id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint") - 1)
    # at most one piece per arc and turn; each shard fills up once, so pieces <= arcs + shards
    values = ",".join(f"({a},{lo}L,{hi}L,{s},{k}L)" for a, lo, hi, s, k in places) or "(0,0L,0L,0,0L)"
    pieces = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(p_arc, lo, hi, shard, first)")
    placed = ranked.join(
        F.broadcast(pieces),
        (F.col("arc") == F.col("p_arc")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    )
    return placed.select(
        "id",
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("rank") - F.col("lo")).alias("slot"),
        *(["doc"] if carry else []),
    )
