"""A corpus pipeline: each stage works on all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; each is written as
Parquet and read again before the next. All but the last return the columns
of documents.

Defined cases, for every stage: null and empty texts are not toxic, not near any
other, hold no benchmark item and have no words to mix, so they end with the
mixing; null ids and null sources are judged like others. Of rows equal in id
and text one stays; rows that share an id with other texts are documents of their
own. An empty table gives an empty one. Columns beside id, text and source are
carried along; one named ``shard`` comes out as ``shard_in``. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandframe.llm import decontam, minhash, mixing, sharding, toxicity
from strandframe.llm._store import Scratch, passing, ready


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; held-out labels teach nothing.

    Without labels of both kinds nothing is learned and nothing dropped, unless all labels are toxic.
    """
    ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.learn(docs, labels.filter(~toxicity.held_out("doc_id")))
    return toxicity.drop_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every near-duplicate group; rows with null id stay."""
    ready(spark)
    return minhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; each row is judged by its own text."""
    ready(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents resampled to the target weights 1, 2, 3, ... of the sources in order; null is the last source."""
    ready(spark)
    return mixing.resample(docs, weigh=mixing.rotating)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard; a null id is placed as an empty key."""
    return sharding.place(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Edit distances, learned lexicons and connected components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    ready(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = docs
        with passing(spark):
            docs = scratch.save(stage(spark, before, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
