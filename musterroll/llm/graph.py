"""Connected components of a graph of any size, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component: its smallest node.

    Large-star links every larger neighbour of a node to its smallest neighbour,
    small-star every smaller one; together they turn each component into one star in a
    number of rounds that grows with the logarithm of its size.  Rounds are written to
    the shared folder, so a lost executor repeats at most the running round.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def clean(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.col("u") != F.col("v")).distinct()

    # u is the larger node of an edge throughout
    now = written(
        clean(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges"
    )
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(smallest(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = written(clean(large), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v")))
        now = written(clean(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
