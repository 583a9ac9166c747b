"""Sequencing tables derived from the relational test tables, alike in Spark and in SQL.

``reads`` turns every order into an alignment against one of two references
(the second is called on the reverse strand). The same SQL text runs on both
engines; only base qualities, which are arrays, are spelled separately.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.operators.demux import Barcode

# alignment_seq, nt_seq, coding_seq: a region of 48 bases from position 6, a reading frame of 42 in it.
FORWARD = ("refA", "GGATCCAAGATGGCTAAACGTGAACTGTTCGATCATTGCGGTTACTCAGTTTAAGCGGCC", 6, 54)
_NT_A = FORWARD[1][6:54]
_CDS_A = _NT_A[3:45]
_FLIP = str.maketrans("ACGT", "TGCA")
_ALN_B = "TTGCAACCGTTACATCAAGGCTTCAGCGATATTGCCGTAGACTTCCATGGTACCTTGACA"
_NT_B = _ALN_B[6:54].translate(_FLIP)[::-1]
REFERENCES = [("refA", FORWARD[1], _NT_A, _CDS_A), ("refB", _ALN_B, _NT_B, _NT_B[0:42])]
L, START, END, CDS = 60, 6, 54, {"refA": (3, 45), "refB": (0, 42)}

_ALN = f"CASE WHEN o_orderkey % 3 = 0 THEN '{_ALN_B}' ELSE '{FORWARD[1]}' END"
_P1, _P2 = "(8 + (o_orderkey * 7) % 45)", "(8 + (o_orderkey * 13) % 45)"
_B1, _B2 = "substr('ACGT', CAST(o_orderkey % 4 + 1 AS INT), 1)", "substr('ACGT', CAST((o_custkey % 4) + 1 AS INT), 1)"

READS = f"""
SELECT read_id, tag, reference_name, CAST(CASE kind WHEN 8 THEN 3 WHEN 9 THEN 10 ELSE 0 END AS INT) AS ref_start, 0 AS flag,
       CASE kind WHEN 6 THEN '20M2I40M' WHEN 7 THEN '30M3D27M' WHEN 8 THEN '3S57M' WHEN 9 THEN '50M' ELSE '60M' END AS cigar,
       CASE kind WHEN 6 THEN concat(substr(m, 1, 20), 'TT', substr(m, 21))
                 WHEN 7 THEN concat(substr(m, 1, 30), substr(m, 34))
                 WHEN 8 THEN concat('GGG', substr(m, 4))
                 WHEN 9 THEN substr(m, 11) ELSE m END AS query_seq
FROM (
  SELECT CAST(o_orderkey AS VARCHAR(20)) AS read_id, CASE WHEN o_custkey % 2 = 0 THEN 'tagA' ELSE 'tagB' END AS tag,
         CASE WHEN o_orderkey % 3 = 0 THEN 'refB' ELSE 'refA' END AS reference_name, CAST(o_custkey % 10 AS INT) AS kind,
         CASE WHEN o_custkey % 4 = 1 THEN concat(substr(m1, 1, {_P2} - 1), {_B2}, substr(m1, {_P2} + 1)) ELSE m1 END AS m
  FROM (SELECT *, CASE WHEN o_orderkey % 5 < 2 THEN aln ELSE concat(substr(aln, 1, {_P1} - 1), {_B1}, substr(aln, {_P1} + 1)) END AS m1
        FROM (SELECT *, {_ALN} AS aln FROM orders) o1) o2) o3
"""
#: 1-based place i of the aligned query to its quality, from the read's number.
QUALITY = "(10 + (CAST(read_id AS BIGINT) * 31 + i * 17) % 31)"

BARCODES = [Barcode("fwd", "CCGNNNNNGCA", hamming_distance=1), Barcode("rvs", "TTANNNNGAC", label_only=True)]
_WORDS = {"fwd": ["ACGTA", "CCATG", "GTTAC", "TAGGC"], "rvs": ["AACC", "GGTT", "CATG"]}
GROUPS = [(0, "g1", {"fwd": "f1"}), (1, "g2", {"fwd": "f2"}), (2, "g3", {"fwd": "f3"}), (3, "g1b", {"fwd": "f1"}), (4, "gx", {"fwd": "f9"})]
LABELS = [(0, "l1", {"rvs": "r1"}), (1, "l2", {"rvs": "r2"})]

#: Reads along a reference with two barcodes; some contexts miss, some barcodes are one letter off or unknown.
TAGGED = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS read_id, CASE WHEN o_custkey % 2 = 0 THEN 'tagA' ELSE 'tagB' END AS tag,
       CASE WHEN o_orderkey % 7 < 4 THEN 'refA' ELSE 'refB' END AS reference_name,
       CASE WHEN o_orderkey % 11 = 0 THEN 'AACCTNNNNNGCATTANNNNGACT' WHEN o_orderkey % 13 = 0 THEN 'AACCG-NNNNNGCATTANNNNGACT'
            WHEN o_orderkey % 17 = 0 THEN 'AACCGNNNNN-GCATTANNNNGACT' ELSE 'AACCGNNNNNGCATTANNNNGACT' END AS gapped_ref,
       concat('AACCG', CASE o_orderkey % 6 WHEN 0 THEN 'ACGTA' WHEN 1 THEN 'CCATG' WHEN 2 THEN 'GTTAC' WHEN 3 THEN 'ACGTT'
                                           WHEN 4 THEN 'CCTTG' ELSE 'GGGGG' END,
              'GCATTA', CASE o_custkey % 5 WHEN 0 THEN 'AACC' WHEN 1 THEN 'GGTT' WHEN 2 THEN 'CATG' WHEN 3 THEN 'AACC' ELSE 'TTTT' END, 'GACT') AS query
FROM orders
"""

#: A mutable 12-letter genotype per customer group: counts of substitutions of a reference.
GENOTYPE_REF = "ATGCATGCATGC"
GENOTYPES = """
SELECT 'refA' AS reference_name, CAST(min(o_orderkey) AS BIGINT) AS id, CAST(count(*) AS BIGINT) AS n_reads, s1, s2
FROM (SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE concat(substr('ATGCATGCATGC', CAST(o_custkey % 12 + 1 AS INT), 1),
               CAST(o_custkey % 12 + 1 AS VARCHAR(9)), substr('TGCATGCATGCA', CAST(o_custkey % 12 + 1 AS INT), 1)) END AS s1,
             CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat(substr('ATGCATGCATGC', CAST(o_orderkey % 5 + 1 AS INT), 1),
               CAST(o_orderkey % 5 + 1 AS VARCHAR(9)), substr('GCATGCATGCAT', CAST(o_orderkey % 5 + 1 AS INT), 1)) END AS s2
      FROM orders) x
WHERE s1 = '' OR s2 = '' OR substr(s1, 2, length(s1) - 2) <> substr(s2, 2, length(s2) - 2)
GROUP BY s1, s2
"""

#: Entities (event type and user class) in four samples over six periods of five days.
COUNTS = """
SELECT concat('s', CAST(user_id % 4 AS VARCHAR(9))) AS sample_label, CAST(user_id % 2 AS INT) AS rep, concat(event_type, '|', CAST(user_id % 7 AS VARCHAR(9))) AS entity,
       CAST(floor((extract(day FROM ts) - 1) / 5) AS DOUBLE) * 10 AS timepoint, CAST(count(*) AS BIGINT) AS c
FROM events GROUP BY 1, 2, 3, 4
"""


TIMEPOINTS = (0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a table's files behind one task, where rows become far wider than they are in the file.
PART = 2 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan dealt out anew by a key, so that every core has a part and a part's size does not grow with the table."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PART)), key)


def _with_views(spark: SparkSession, sf_dir: str, text: str, names: tuple[str, ...], frames: dict[str, DataFrame] | None = None) -> DataFrame:
    frames = frames or {n: table(spark, sf_dir, n) for n in names}
    for n in names:
        text = re.sub(rf"\bFROM {n}\b", f"FROM {{{n}}}", text)
    return spark.sql(text, **frames)


def references(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REFERENCES, "reference_name string, alignment_seq string, nt_seq string, coding_seq string")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The keys alone are dealt out, before they become reads.
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    df = _with_views(spark, sf_dir, READS, ("orders",), {"orders": orders})
    n = F.length(S.aligned_query(F.col("query_seq"), S.cigar_ops(F.col("cigar"))))
    q = lambda i: (10 + (F.col("read_id").cast("long") * 31 + i * 17) % 31).cast("int")
    pad = F.when(F.col("cigar").startswith("3S"), F.array_repeat(F.lit(2), 3)).otherwise(F.array().cast("array<int>"))
    return df.withColumn("quals", F.concat(pad, F.transform(F.sequence(F.lit(1), n), q))).withColumn("bc", F.lit(None).cast("string"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_views(spark, sf_dir, TAGGED, ("orders",))


def words(spark: SparkSession) -> DataFrame:
    rows = [(t, k, f"{t[0]}{k + 1}", s) for t, seqs in _WORDS.items() for k, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "barcode_type string, ord long, name string, seq string")


def groups(spark: SparkSession, rows=GROUPS) -> DataFrame:
    return spark.createDataFrame(rows, "group_order int, group string, members map<string,string>")


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_views(spark, sf_dir, GENOTYPES, ("orders",))
    subs = F.array_join(F.filter(F.array("s1", "s2"), lambda x: x != ""), ", ")
    return df.withColumnRenamed("n_reads", "count").withColumn("NT_substitutions", subs).drop("s1", "s2")


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_views(spark, sf_dir, COUNTS, ("events",))
    return df.select(F.lit("grp").alias("group"), F.col("rep").alias("replicate"), "sample_label", "entity", "timepoint", "c")
