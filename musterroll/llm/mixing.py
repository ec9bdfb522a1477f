"""Mixing sources to target weights by Pfair scheduling of blocks.

Every source's rows are dealt into blocks.  Block j of a source with weight w may be
placed from slot floor(j / w) and must be placed before slot ceil((j + 1) / w); the
earliest deadline goes first.  At every prefix of the mix each source is then less than
one block away from its share.

With whole weights p_i of sum q the schedule repeats every q slots, so at most one period
is worked out, and every row finds its slot by arithmetic on its rank in its source.
When a source runs out a new phase begins with the weights of those left; there are as
many phases as sources, and a phase is worked out no further than it lasts.  The schedule
is a table with a row for each source of a phase.  A short one is broadcast; one of many
sources is written in pieces, spread to a row per block and joined by source and block.
Ranks come from counts per source and hash bucket, so a source that holds most rows is
spread over all tasks.

Any number of sources is taken.  A count per source comes to the driver, and working the
schedule out there takes time by phases times weights: some tens of seconds for thousands
of sources of widely different sizes.

Edge cases: a null source is a source of its own; equal rows are placed one by one; an
empty table gives an empty result; a source without a stated weight raises an error.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from musterroll.llm.shared import scratch_root

BLOCK_ROWS, BUCKETS = 64, 1024
RESOLUTION, EXPONENT = 1000, 0.9
#: Characters of a schedule that is broadcast, and of a piece of a longer one.
SCHEDULE_TEXT = 1 << 18
#: Blocks of a source that are spread to rows at a time.
SPREAD = 1 << 14


def target_weights(rows: Mapping, exponent: float = EXPONENT, resolution: int = RESOLUTION) -> dict:
    """Whole weights of about ``resolution`` in sum, from row counts raised to a power."""
    raised = {s: n**exponent for s, n in rows.items()}
    total = sum(raised.values()) or 1
    return {s: max(1, round(resolution * x / total)) for s, x in raised.items()}


def period(weights: Mapping, blocks: Mapping | None = None) -> list:
    """One period of the earliest-deadline-first schedule: the source of each slot.

    With ``blocks`` it ends where the first source has placed that many.
    """
    q = sum(weights.values())
    waiting = [(0, str(s), s, 0) for s in weights]  # release slot, name, source, block
    heapq.heapify(waiting)
    ready, out = [], []
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            _, name, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * q // weights[s]), name, s, j))
        _, name, s, j = heapq.heappop(ready)
        out.append(s)
        if blocks is not None and j + 1 == blocks[s]:
            break
        heapq.heappush(waiting, ((j + 1) * q // weights[s], name, s, j + 1))
    return out


def phases(rows: Mapping, weights: Mapping, block_rows: int = BLOCK_ROWS) -> Iterator[dict]:
    """Phases of the mix, one by one: each ends with the last block of one source."""
    left = {s: -(-n // block_rows) for s, n in rows.items() if n}
    used, start, short = dict.fromkeys(left, 0), 0, 0
    while left:
        now = {s: weights[s] for s in left}
        q, order = sum(now.values()), period(now, left)
        slots: dict = {}
        for i, s in enumerate(order):
            slots.setdefault(s, []).append(i)
        last = order[-1]
        if len(slots[last]) == left[last]:  # ran out in the first period
            length, taken = len(order), {s: len(x) for s, x in slots.items()}
        else:
            ends = {s: (n - 1) // now[s] * q + slots[s][(n - 1) % now[s]] for s, n in left.items()}
            last = min(ends, key=ends.get)
            length = ends[last] + 1
            taken = {s: length // q * now[s] + sum(i < length % q for i in x) for s, x in slots.items()}
        yield {"start": start, "q": q, "slots": slots, "first": {s: used[s] for s in slots}, "taken": taken, "short": short}
        for s, n in taken.items():
            used[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        short += -rows[last] % block_rows
        start += length


def _lines(plan: Iterable[dict]) -> Iterator[str]:
    """A line for each source of each phase; names in hexadecimal digits."""
    for n, p in enumerate(plan):
        for s, slots in p["slots"].items():
            lo, taken = p["first"][s], p["taken"][s]
            if taken:
                held = ",".join(map(str, slots))
                yield f"{n} {s.encode().hex()} {lo} {lo + taken} {p['start']} {p['q']} {p['short']} {held}"


def _pieces(lines: Iterable[str], most: int) -> Iterator[str]:
    held, size = [], 0
    for line in lines:
        if held and size + len(line) >= most:
            yield "\n".join(held)
            held, size = [], 0
        held.append(line)
        size += len(line) + 1
    yield "\n".join(held)


def _parsed(spark: SparkSession, piece: str) -> DataFrame:
    """(phase, s, lo, hi, start, q, short, slots) of a piece of the schedule."""
    lines = spark.range(1).select(F.explode(F.split(F.lit(piece), "\n")).alias("line")).where("line != ''")
    names = ("lo", "hi", "start", "q", "short")
    return lines.select(F.split("line", " ").alias("x")).select(
        F.col("x")[0].cast("int").alias("phase"),
        F.decode(F.unhex(F.col("x")[1]), "UTF-8").alias("s"),
        *(F.col("x")[i].cast("bigint").alias(c) for i, c in enumerate(names, 2)),
        F.split(F.col("x")[7], ",").cast("array<bigint>").alias("slots"),
    )


def _schedule(spark: SparkSession, plan: Iterable[dict], most: int) -> tuple[DataFrame, bool]:
    """The schedule as a table, and whether it is short (``most`` characters)."""
    pieces = _pieces(_lines(plan), most)
    piece, after = next(pieces), next(pieces, None)
    if after is None and len(piece) <= most:
        return _parsed(spark, piece), True
    path = f"{scratch_root(spark)}/schedule-{uuid.uuid4().hex}"
    while piece is not None:
        _parsed(spark, piece).write.mode("append").parquet(path)
        piece, after = after, next(pieces, None)
    return spark.read.parquet(path), False


def _slot(block: Column) -> Column:
    """Slot of a block by its place among the source's blocks of the phase."""
    j, size = block - F.col("lo"), F.size("slots").cast("bigint")
    return F.col("start") + F.floor(j / size).cast("bigint") * F.col("q") + F.get("slots", F.pmod(j, size).cast("int"))


def _by_block(schedule: DataFrame) -> DataFrame:
    """(s, at, phase, slot, short): the schedule with a row per block.

    The blocks of a source are spread in runs, so a source of most rows is no single task.
    """
    runs = schedule.withColumn("run", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(SPREAD).cast("bigint"))))
    last = F.least(F.col("run") + SPREAD, F.col("hi")) - 1
    spread = runs.repartition("s", "run").withColumn("at", F.explode(F.sequence("run", last)))
    return spread.select("s", "at", "phase", _slot(F.col("at")).alias("slot"), "short")


def _key(group: str) -> Column:
    return F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    group: str = "source",
    id: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    buckets: int = BUCKETS,
    exponent: float = EXPONENT,
    carry: bool = False,
    schedule_text: int = SCHEDULE_TEXT,
) -> DataFrame:
    """Place of every row in the mix: (id, source, block, phase, slot, position, doc).

    ``position`` counts rows from 0 without gaps.  Phase 0 holds all sources at their
    target weights; later phases hold those that are left.  ``doc`` is the whole row as a
    struct with ``carry``, else absent.
    """
    spark = docs.sparkSession
    rows = docs.select(
        _key(group).alias("g"),
        F.pmod(F.xxhash64(F.col(id)), F.lit(buckets)).cast("int").alias("b"),
        F.col(id).alias("id"),
        F.col(group).alias("source"),
        *([F.struct("*").alias("doc")] if carry else []),
    )
    counts = rows.groupBy("g", "b").agg(F.count("*").alias("n"))
    totals = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count("*").alias("n")).collect()}
    if weights is None:
        chosen = target_weights(totals, exponent)
    else:
        chosen = {"-" if s is None else f"+{s}": w for s, w in weights.items()}
        if lacking := sorted(set(totals) - set(chosen)):
            raise ValueError(f"no weight for sources {lacking}")
        if any(int(w) != w or w < 1 for w in chosen.values()):
            raise ValueError("weights must be whole and positive")
    schedule, short = _schedule(spark, phases(totals, chosen, block_rows), schedule_text)

    offsets = counts.select(
        F.col("g").alias("og"),
        F.col("b").alias("ob"),
        (F.sum("n").over(Window.partitionBy("g").orderBy("b")) - F.col("n")).alias("before"),
    )  # at most buckets rows per source
    inside = Window.partitionBy("g", "b").orderBy(F.xxhash64("id"), "id")
    ranked = (
        rows.withColumn("r", F.row_number().over(inside).cast("bigint") - 1)
        .join(offsets, (F.col("g") == F.col("og")) & (F.col("b") == F.col("ob")))
        .withColumn("rank", F.col("before") + F.col("r"))
        .withColumn("block", F.floor(F.col("rank") / block_rows).cast("bigint"))
    )
    if short:
        in_phase = (F.col("g") == F.col("s")) & (F.col("block") >= F.col("lo")) & (F.col("block") < F.col("hi"))
        placed = ranked.join(F.broadcast(schedule), in_phase).withColumn("slot", _slot(F.col("block")))
    else:
        placed = ranked.join(_by_block(schedule), (F.col("g") == F.col("s")) & (F.col("block") == F.col("at")))
    slot = F.col("slot")
    return placed.select(
        "id",
        "source",
        "block",
        "phase",
        slot,
        (slot * block_rows + F.pmod("rank", F.lit(block_rows)) - F.col("short")).alias("position"),
        *(["doc"] if carry else []),
    )
