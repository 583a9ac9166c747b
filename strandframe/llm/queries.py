"""The registered queries of the training-data operators, and their SQL.

Each query applies one operator to its whole table and derives the columns of
its result; the operators themselves keep their own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.llm import decontam, embeddings, hmm, licenses, lines, minhash, mixing, repair, sharding, tokens, toxicity, trie, warc
from strandframe.llm._store import ready


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources, weighing 1, 2, 3 in turn, takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weigh=mixing.rotating, columns=["doc_id"])
    return mixed.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__taken").alias("taken"), F.col("__by_shard").alias("taken_by_shard"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines found on many sites, as counts and a digest of the text left."""
    cleaned = lines.clean(_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
        F.length("__clean").cast("long").alias("kept_chars"), F.md5(F.col("__clean").cast("binary")).alias("kept_md5"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item found in it."""
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by a lexicon learned without the held-out rows."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, labels.filter(~toxicity.held_out("doc_id")))
    scored = toxicity.scores(docs, lexicon)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back by their boundary chains."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and hidden Markov scores of all documents."""
    return hmm.score(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest and license of every document, and the licenses its lines name."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("__digest").alias("digest"), F.col("__license").alias("license"), F.array_join("__notices", ",").alias("notices")
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"), slot_name="slot")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the conversations, rebuilt in groups of five."""
    return trie.prefix_trie(*trie.rebuild(_table(spark, sf_dir, "conversations")))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation, with a digest of the repaired turns."""
    return repair.damaged_report(_table(spark, sf_dir, "conversations"))


def op13_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Bytes and tokens of every document by a byte-level BPE tokenizer."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    counted = tokens.count(_table(spark, sf_dir, "documents"), tokenizer, columns=["doc_id"])
    n = F.col("__tokens")
    return counted.select("doc_id", F.col("__bytes").alias("n_bytes"), n.alias("n_tokens"), (n > 1024).alias("over_limit"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_minhash_near_dedup, op2_mixing, op3_line_dedup, op4_decontamination, op5_toxicity,
            op6_warc, op7_hmm_scoring, op8_license_scan, op9_embedding_near_dedup, op10_sharding,
            op11_prefix_trie, op12_structure_repair, op13_token_counts,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": lines.ORACLE.format(sites=lines.SITES),
        "op6_warc": warc.ORACLE,
        "op8_license_scan": licenses.oracle(),
        "op10_sharding": sharding.oracle("documents"),
    }
