"""Selections of genotypes by bitmaps: which rows have a letter at a position, or a label.

Rows are numbered once; a term's bitmaps (one for each 32 768 rows that have it) lie
sorted by term, so a selection reads those of its own terms, whatever the number of
genotypes, and rows only of the stretches that are left. All of it is aggregates and joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.operators.common import ranked
from strandframe.scratch import Scratch, shared_dir

#: Runs of rows that are numbered for themselves.
RUNS = 4096


def letter(pos: int, mut: str) -> str:
    """The term of a changed letter at a 0-based position."""
    return f"@{pos}:{mut}"


def label(col: str, value) -> str:
    """The term of a label's value; None is a value too."""
    return f"#{col}!" if value is None else f"#{col}={value}"


def version(df: DataFrame) -> str:
    """What identifies the files that df reads: their names, lengths and times; df must read files."""
    spark, found = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        at = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append(f"{name} {at.getLen()} {at.getModificationTime()}")
    if not found:
        raise ValueError("no files are read: name a version")
    return sha256("\n".join(found).encode()).hexdigest()


def _has(bitmap: Column, place: Column) -> Column:
    """Whether a bit is set; places count from the lowest bit of the first byte."""
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), (place % 8).cast("int") + 1)) != 0, F.lit(False))


@dataclass(frozen=True)
class Index:
    """Rows (with their bucket and place) and the bitmaps of terms, as tables in the shared folder."""

    rows: DataFrame
    bitmaps: DataFrame
    columns: tuple[str, ...]

    def _any(self, terms: list[str]) -> DataFrame:
        return self.bitmaps.filter(F.col("term").isin(terms)).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def bits(self, having: list[list[str]]) -> DataFrame:
        """(bucket, bitmap) of rows that have one term at least of every clause; no clause: all rows."""
        if not having:
            return self._any([""])
        clauses = None
        for terms in having:
            some = self._any(terms)
            clauses = some if clauses is None else clauses.unionByName(some)
        both = clauses.groupBy("bucket").agg(F.count("*").alias("n"), F.bitmap_and_agg("bitmap").alias("bitmap"))
        return both.filter(F.col("n") == len(having)).drop("n")

    def count(self, having: list[list[str]] = (), without: list[str] = ()) -> DataFrame:
        """One row, n: how many rows are selected; no row is read."""
        held = self.bits(list(having)).withColumn("sign", F.lit(1))
        if without:
            held = held.unionByName(self.bits([*having, list(without)]).withColumn("sign", F.lit(-1)))
        return held.agg(F.coalesce(F.sum(F.col("sign") * F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias("n"))

    def select(self, having: list[list[str]] = (), without: list[str] = ()) -> DataFrame:
        """The rows that have one term at least of every clause, and none of those to be without."""
        held = self.bits(list(having)).filter(F.bitmap_count("bitmap") > 0)
        out = self.rows.join(held.select(F.col("bucket").alias("__b"), F.col("bitmap").alias("__has")), F.col("__bucket") == F.col("__b")).filter(_has(F.col("__has"), F.col("__place")))
        if without:
            gone = self._any(list(without)).select(F.col("bucket").alias("__c"), F.col("bitmap").alias("__not"))
            out = out.join(gone, F.col("__bucket") == F.col("__c"), "left").filter(~_has(F.col("__not"), F.col("__place")))
        return out.select(*(F.col(f"`{c}`") for c in self.columns))


def index(genotypes: DataFrame, labels: tuple[str, ...] = (), name: str = "genotypes", of: str | None = None) -> Index:
    """The index of genotypes (points, and columns that serve as labels), built unless there is one of this version.

    of: the version of the input, else that of the files it reads. Tables are kept by name, version, labels and
    columns below the shared folder; those of other versions are not read. Null points are none, null letters or
    positions no term.
    """
    spark = genotypes.sparkSession
    key = "\n".join((of or version(genotypes), *labels, "", genotypes.schema.json()))
    root = f"{shared_dir(spark)}/index-{name}-{sha256(key.encode()).hexdigest()[:32]}"
    if not _there(spark, f"{root}/bitmaps/_SUCCESS"):
        # Written once: numbering and sorting read their input several times.
        scratch = Scratch(spark, "selections")
        genotypes = scratch.save(genotypes)
        whole = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in genotypes.columns))))
        placed = ranked(genotypes, [], [F.pmod(whole, F.lit(RUNS))], [whole], "__n")
        placed = placed.withColumns({"__bucket": F.expr("bitmap_bucket_number(__n)"), "__place": F.expr("bitmap_bit_position(__n)")})
        placed.repartitionByRange("__bucket").sortWithinPartitions("__bucket").write.mode("overwrite").parquet(f"{root}/rows")
        scratch.drop(0)
        stored = spark.read.parquet(f"{root}/rows")
        changed = F.transform(F.filter("points", lambda p: p["pos"].isNotNull() & p["mut"].isNotNull()), lambda p: F.concat(F.lit("@"), p["pos"].cast("string"), F.lit(":"), p["mut"]))
        named = [F.when(F.col(f"`{c}`").isNull(), F.lit(f"#{c}!")).otherwise(F.concat(F.lit(f"#{c}="), F.col(f"`{c}`").cast("string"))) for c in labels]
        terms = stored.select("__bucket", "__place", F.explode(F.concat(F.array(F.lit(""), *named), F.coalesce(changed, F.array().cast("array<string>")))).alias("term"))
        bitmaps = terms.groupBy("term", F.col("__bucket").alias("bucket")).agg(F.bitmap_construct_agg("__place").alias("bitmap"))
        bitmaps.repartitionByRange("term", "bucket").sortWithinPartitions("term", "bucket").write.mode("overwrite").parquet(f"{root}/bitmaps")
    return Index(spark.read.parquet(f"{root}/rows"), spark.read.parquet(f"{root}/bitmaps"), tuple(genotypes.columns))


def _there(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
