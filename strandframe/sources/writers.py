"""Writers: CSV without index, FASTA, FASTQ, SAM, BAM, partitioned alignments, alignment text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strandframe.sources.ranges import BamSource, register


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_demuxed(df: DataFrame, path: str) -> None:
    """One folder per tag and barcode group; readers prune by them."""
    df.write.mode("overwrite").partitionBy("tag", "output_file_barcodes").parquet(path)


def fasta_lines(df: DataFrame, name: str, seq: str, count: str | None = None) -> DataFrame:
    """Record text; with count every sequence as often as it was seen."""
    rows = df.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))) if count else df
    return rows.select(F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.col(seq)).alias("value"))


def write_fasta(df: DataFrame, path: str, name: str = "id", seq: str = "seq", count: str | None = None, gzip: bool = False) -> None:
    out = fasta_lines(df, name, seq, count).write.mode("overwrite")
    (out.option("compression", "gzip") if gzip else out).text(path)


def write_alignments(df: DataFrame, path: str) -> None:
    """Three lines per genotype of ``genotype_alignments``, most abundant first."""
    head = F.concat(F.lit("> "), "reference_name", F.lit(" "), "genotype_ID", F.lit(" x"), F.col("count").cast("string"))
    df.orderBy("reference_name", "genotype_rank").select(F.concat_ws("\n", head, "ref", "match", "query").alias("value")).write.mode("overwrite").text(path)


def _symbols(quals: str):
    return F.array_join(F.transform(quals, lambda q: F.char(q + 33)), "")


def write_fastq(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Four-line records of read_id, description, seq and quals."""
    head = F.concat_ws(" ", F.concat(F.lit("@"), "read_id"), "description")
    out = df.select(F.concat_ws("\n", head, "seq", F.lit("+"), _symbols("quals")).alias("value")).write.mode("overwrite")
    (out.option("compression", "gzip") if gzip else out).text(path)


def write_sam(df: DataFrame, path: str) -> None:
    """Alignment lines without a header."""
    text = lambda c, none: F.coalesce(F.col(c).cast("string"), F.lit(none))
    quals = F.when(F.col("quals").isNull(), "*").otherwise(_symbols("quals"))
    tags = (F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{t}:"), F.col(c).cast("string"))) for c, t in (("nm", "NM:i"), ("bc", "BC:Z")))
    fields = ["read_id", text("flag", "0"), text("reference_name", "*"), (F.col("ref_start") + 1).cast("string"), F.lit("255"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "query_seq", quals, *tags]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)


def write_bam(df: DataFrame, path: str, references: dict[str, int], by: list[str] | None = None, split: bool = True, mode: str = "overwrite") -> int:
    """Alignments as sorted BAM files with indexes below path; references: lengths by name, in order. Returns the number of rows.

    With by (tag and barcode group, say) every file holds one group and bears its values, joined by ``_``. Groups are
    spread over tasks by place, each task adding its number to the names; without split each group is one file of one task.
    A task that fails or is run twice leaves nothing: files get their names when all is written.
    """
    spark = df.sparkSession
    register(spark, BamSource)
    order = F.coalesce(F.array_position(F.array(*(F.lit(n) for n in references)).cast("array<string>"), F.coalesce("reference_name", F.lit("*"))), F.lit(0))
    order = F.when(order > 0, order).otherwise(len(references) + 1)
    name = F.concat_ws("_", *(F.coalesce(F.regexp_replace(F.col(c).cast("string"), "[^A-Za-z0-9.+-]", "-"), F.lit("")) for c in by)) if by else F.lit("part")
    rows = df.withColumn("file", name).withColumn("__ref", order).withColumn("ref_start", F.when(order > len(references), -1).otherwise(F.col("ref_start")))
    keys = ["file", "__ref", "ref_start"]
    if split:
        # Reads of one place are cut by name too: a place may hold most of them.
        rows = rows.repartitionByRange(*keys, "read_id").withColumn("file", F.concat("file", F.format_string(".%05d", F.spark_partition_id())))
    else:
        rows = rows.repartition("file")
    rows = rows.sortWithinPartitions(*keys, "read_id")
    seen = Observation()
    wanted = ["read_id", "reference_name", "ref_start", "flag", "cigar", "query_seq", "quals", "bc", "nm"]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows")).select("file", *wanted)
    counted.write.format(BamSource.name()).option("path", path).option("references", json.dumps(references)).mode(mode).save()
    return seen.get["rows"]
