"""Mutation statistics per sample, and tables derived from distributions."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandframe.functions.seq import NTS
from strandframe.operators.common import distribution
from strandframe.scratch import Scratch

CHANGES = [f"{a}->{b}" for a in NTS for b in NTS if a != b]
_TRANSITIONS = ("AG", "GA", "TC", "CT")


def distribution_mean(df: DataFrame, by: list[str], x: str = "x", n: str = "total") -> DataFrame:
    return df.groupBy(*by).agg((F.sum(F.col(x) * F.col(n)) / F.sum(n)).alias("mean"))


def distribution_median(df: DataFrame, by: list[str], x: str = "x", n: str = "total") -> DataFrame:
    """The median of a histogram, cut to an integer."""
    return df.groupBy(*by).agg(F.percentile(x, F.lit(0.5), F.col(n)).cast("long").alias("median"))


def _mean_median(df: DataFrame, by: list[str], name: str) -> DataFrame:
    mean = F.sum(F.col("x") * F.col("total")) / F.sum("total")
    return df.groupBy(*by).agg(mean.alias(f"mean_{name}_mutations_per_seq"), F.percentile("x", F.lit(0.5), F.col("total")).cast("long").alias(f"median_{name}_mutations_per_seq"), F.sum("total").alias(f"__{name}_seqs"))


def mutation_stats(
    by: list[str], nt_distribution: DataFrame, nt_tidy: DataFrame, genotypes: DataFrame, failures: DataFrame,
    aa_distribution: DataFrame | None = None, aa_tidy: DataFrame | None = None,
) -> DataFrame:
    """One row per group: totals, means, medians, indels, transitions and the twelve substitutions.

    The twelve ``X->Y_unique`` columns count cells that occur at all. Samples
    without genotypes have no row. Indel lengths are sums over genotypes, each once.
    """
    letters = F.concat("wt", "mutation")
    n = F.coalesce("total_count", F.lit(0))
    cell = (n > 0).cast("long")
    cells = nt_tidy.filter("total_count is not null").groupBy(*by).agg(
        F.countDistinct("position").alias("reference_length"), F.sum(n).alias("total_NT_mutations"), F.sum(cell).alias("unique_NT_mutations"),
        F.sum(F.when(letters.isin(*_TRANSITIONS), n).otherwise(0)).alias("transitions"), F.sum(F.when(~letters.isin(*_TRANSITIONS), n).otherwise(0)).alias("transversions"),
        F.sum(F.when(letters.isin(*_TRANSITIONS), cell).otherwise(0)).alias("transitions_unique"), F.sum(F.when(~letters.isin(*_TRANSITIONS), cell).otherwise(0)).alias("transversions_unique"),
        *(F.sum(F.when(letters == c[0] + c[-1], n).otherwise(0)).alias(c) for c in CHANGES), *(F.sum(F.when(letters == c[0] + c[-1], cell).otherwise(0)).alias(f"{c}_unique") for c in CHANGES),
    )
    kinds = genotypes.select(*by, "NT_substitutions", "NT_insertions", "NT_deletions", "NT_insertion_length", "NT_deletion_length", "count").filter("count > 0")
    unique = kinds.select(*by, "NT_substitutions", "NT_insertions", "NT_deletions").distinct().groupBy(*by).agg(F.count("*").alias("unique_genotypes"))
    indels = kinds.groupBy(*by).agg(F.sum("NT_insertion_length").alias("total_insertion_length"), F.sum("NT_deletion_length").alias("total_deletion_length"))
    lost = failures.groupBy(*by).agg(F.count("*").alias("total_failed_seqs"))
    out = _mean_median(nt_distribution, by, "NT").join(cells, by, "left").join(unique, by).join(indels, by, "left").join(lost, by, "left")
    if aa_distribution is not None:
        aa = aa_tidy.filter("total_count is not null").groupBy(*by).agg(F.sum("total_count").alias("total_AA_mutations"), F.sum((F.col("total_count") > 0).cast("long")).alias("unique_AA_mutations"))
        out = out.join(_mean_median(aa_distribution, by, "AA").drop("__AA_seqs"), by, "left").join(aa, by, "left")
    out = out.withColumnRenamed("__NT_seqs", "total_seqs").withColumn("total_failed_seqs", F.coalesce("total_failed_seqs", F.lit(0)))
    base = F.bround(F.col("mean_NT_mutations_per_seq") / F.col("reference_length"), 10)
    out = out.withColumn("mean_NT_mutations_per_base", base).withColumn("mean_NT_mutations_per_seq", F.bround("mean_NT_mutations_per_seq", 2))
    if aa_distribution is not None:
        out = out.withColumn("mean_AA_mutations_per_seq", F.bround("mean_AA_mutations_per_seq", 2))
    return out


def merge_distributions(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One distribution of all that share by, over what else told them apart."""
    return distribution(df, "x", by or [], "total")


def reference_abundance(df: DataFrame, n: int, count: str = "count") -> DataFrame:
    per = df.groupBy("reference_name").agg(F.sum(count).alias("total"))
    return per.orderBy(F.desc("total"), "reference_name").limit(n)


def alignment_stats(sam: DataFrame) -> DataFrame:
    """(ID, flag, length, mapped_length, identity) of SAM rows with cigar and nm."""
    from strandframe.functions.seq import cigar_ops

    ops = cigar_ops(F.col("cigar"))
    total = lambda kinds: F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda a, x: a + x["n"])
    mapped = total("MI=X")
    return sam.select(
        F.col("read_id").alias("ID"), "flag", total("MISH=X").alias("length"), mapped.alias("mapped_length"), ((mapped - F.col("nm")) / mapped).alias("identity")
    )


class Stopwatch:
    """Steps of a pipeline, counted and timed while they run.

    A step is written to the shared folder once; its rows are counted by an observation of that very
    write, and the next step reads what was written, so no step runs twice.
    """

    def __init__(self, spark: SparkSession, name: str = "steps"):
        self.spark, self.scratch, self.rows = spark, Scratch(spark, name), []

    def step(self, name: str, df: DataFrame) -> DataFrame:
        """df as it was written, after its rows and seconds are noted."""
        seen, begun = Observation(), time.perf_counter()
        out = self.scratch.save(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.rows.append((name, seen.get["rows"], time.perf_counter() - begun))
        return out

    def table(self) -> DataFrame:
        """(pipeline_step, sequences, seconds) of the steps so far, in their order."""
        return self.spark.createDataFrame(self.rows, "pipeline_step string, sequences long, seconds double")


def point_sizes(df: DataFrame, col: str, lo: float = 1.0, hi: float = 20.0) -> DataFrame:
    """col scaled to lo..hi by its extremes."""
    edge = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    span = F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0))
    scaled = F.lit(lo) + F.coalesce((F.col(col) - F.col("__lo")) / span, F.lit(0.0)) * (hi - lo)
    return df.crossJoin(F.broadcast(edge)).withColumn("point_size", scaled).drop("__lo", "__hi")
