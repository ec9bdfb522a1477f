"""A corpus made ready for training: five stages, each one operator with its decisions.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of documents,
mixing and sharding with their own after them; its result is written as Parquet and read
again as the next stage's ``docs``.

1. toxicity: documents that the model calls toxic go.
2. near duplicates: one document of each group of the n-gram Jaccard join stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: every document gets its position in the mix, and the phase of it.  Phase 0
   runs at the target weights; when a source has no more rows the others go on.
5. sharding: every document gets its shard and its slot there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.llm import contamination, jaccard, mixing, shards, toxicity
from musterroll.llm.shared import table, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("phase", "position")]
    return mixing.mix(docs, carry=True).select(*own, "phase", "position")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = shards.ring_shards(docs, carry=True)
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*own, "shard", "slot")


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", unique),
    ("decontamination", unseen),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Training and similarity joins are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
