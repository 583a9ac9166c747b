"""Queries on files and configuration: tables are written in a format, read back by its reader, and compared with SQL on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe import config
from strandframe.functions import seq as S
from strandframe.operators import align, enrich, explore, umi, variants
from strandframe.operators.common import label_union, small
from strandframe.plans import synthetic as T
from strandframe.plans.queries_enrich import GENO, _geno, _geno_ref
from strandframe.plans.queries_sequence import _CODONS, CALLS, MIN_Q
from strandframe.scratch import Scratch
from strandframe.sources import readers, writers

#: Sum of a read's qualities: soft-clipped bases have 2 each, the others that of their place.
_QUALITY = """CAST(2 * clipped + list_sum([(10 + (CAST(read_id AS BIGINT) * 31 + i * 17) % 31) for i in range(1, length(query_seq) - clipped + 1)]) AS BIGINT)"""
_READS = f"(SELECT *, CASE WHEN cigar LIKE '3S%' THEN 3 ELSE 0 END AS clipped FROM ({T.READS}))"
_COLUMNS = ("read_id", "tag", "reference_name", "ref_start", "flag", "cigar", "query_seq")


def _folder(spark: SparkSession, name: str) -> str:
    return Scratch(spark, "files").root + "/" + name


def _sum(quals: str):
    return F.aggregate(quals, F.lit(0).cast("long"), lambda a, x: a + x)


def fastq_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads written as FASTQ in a folder per tag, one of them gzipped, found by the tags' run names, and read back as one table."""
    d, root = T.reads(spark, sf_dir).select("read_id", F.col("tag").alias("description"), F.col("query_seq").alias("seq"), "quals"), _folder(spark, "fastq")
    tags = [{"tag": r.description, "runname": [f"run_{r.description}"], "bs_project_ID": "unused"} for r in d.select("description").distinct().orderBy("description").collect()]
    for k, tag in enumerate(tags):
        writers.write_fastq(d.filter(F.col("description") == tag["tag"]), f"{root}/{k}/{tag['runname'][0]}/fastq_pass", gzip=k == 0)
    paths = [p for tag in tags for p in readers.find_fastqs(root, tag[readers.choose_source(tag)], "fastq_pass")]
    return readers.read_fastq(spark, paths).select("read_id", "description", "seq", _sum("quals").alias("quality_sum"))


FASTQ = f"SELECT read_id, tag AS description, query_seq AS seq, {_QUALITY} AS quality_sum FROM {_READS}"


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.reads(spark, sf_dir).withColumn("nm", F.lit(1)).withColumn("bc", F.col("tag"))


def sam_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alignments written as SAM text and read back."""
    path = _folder(spark, "sam")
    writers.write_sam(_aligned(spark, sf_dir), path)
    return readers.read_sam(spark, path).withColumn("tag", F.col("bc")).select(*_COLUMNS, _sum("quals").alias("quality_sum"))


def bam_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alignments written as BAM files and read back by byte ranges."""
    path = _folder(spark, "bam")
    writers.write_bam(_aligned(spark, sf_dir), path, {name: len(seq) for name, seq, _, _ in T.REFERENCES})
    return readers.read_bam(spark, path, split=1 << 18).withColumn("tag", F.col("bc")).select(*_COLUMNS, _sum("quals").alias("quality_sum"))


def bam_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignments to one reference, read from BAM files."""
    path = _folder(spark, "bam")
    writers.write_bam(_aligned(spark, sf_dir), path, {name: len(seq) for name, seq, _, _ in T.REFERENCES})
    return readers.read_bam(spark, path, reference="refB").select("read_id", "reference_name", "ref_start", "cigar")


def demuxed_bam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alignments written as sorted BAM files, one per tag and group, and every file read back by its name."""
    path = _folder(spark, "groups")
    d = _aligned(spark, sf_dir).withColumn("output_file_barcodes", F.concat(F.lit("g"), (F.col("read_id").cast("long") % 3).cast("string")))
    writers.write_bam(d, path, {name: len(seq) for name, seq, _, _ in T.REFERENCES}, ["tag", "output_file_barcodes"], split=False)
    files = {f"{tag}_g{k}": readers.read_bam(spark, f"{path}/{tag}_g{k}.bam", tag) for tag in ("tagA", "tagB") for k in range(3)}
    return label_union(files, "file").select("file", "tag", "read_id", "reference_name", "ref_start", "cigar", _sum("quals").alias("quality_sum"))


DEMUXED = f"SELECT tag || '_g' || (read_id::BIGINT % 3) AS file, tag, read_id, reference_name, ref_start, cigar, {_QUALITY} AS quality_sum FROM {_READS}"
ALIGNMENTS = f"SELECT {', '.join(_COLUMNS)}, {_QUALITY} AS quality_sum FROM {_READS}"
BY_REFERENCE = f"SELECT read_id, reference_name, ref_start, cigar FROM ({T.READS}) WHERE reference_name = 'refB'"


def fasta_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads written as FASTA and read back."""
    path = _folder(spark, "fasta")
    writers.write_fasta(T.reads(spark, sf_dir).select(F.concat_ws(" ", "read_id", "tag").alias("id"), F.col("query_seq").alias("seq")), path)
    return readers.read_fasta(spark, path)


FASTA = f"SELECT read_id AS id, tag AS description, query_seq AS seq FROM ({T.READS})"


def msa_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of one length as an alignment with features in their headers, and with one column blanked by a dot."""
    path = _folder(spark, "msa")
    d = T.tagged(spark, sf_dir)
    dotted = F.when(F.col("read_id").cast("long") % 1000 == 1, F.overlay("query", F.lit("."), F.lit(3))).otherwise(F.col("query"))
    writers.write_fasta(d.select(F.concat(F.col("read_id"), F.lit("__tag:"), F.col("tag")).alias("id"), dotted.alias("seq")), path)
    return readers.read_msa(spark, path, S.NT_ALPHABET).select("id", F.element_at("features", "tag").alias("tag"), "seq")


MSA = f"SELECT read_id AS id, tag, CASE WHEN (SELECT bool_or(o_orderkey % 1000 = 1) FROM orders) THEN substr(query, 1, 2) || '-' || substr(query, 4) ELSE query END AS seq FROM ({T.TAGGED})"


def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a layout table with a list column and a default, written as CSV and read back for one tag."""
    path = _folder(spark, "csv")
    d = T.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b").alias("tag"), F.col("c_custkey").cast("string").alias("name"),
        F.concat_ws(", ", F.col("c_nationkey").cast("string"), F.lit("x")).alias("runname"), F.when(F.col("c_custkey") % 3 == 0, "1").alias("n"),
    )
    writers.write_csv(d, path)
    got = readers.read_csv(spark, path, tag="a", required=("tag", "name"), defaults={"n": 7, "m": 0}, lists=("runname",))
    return got.select("name", F.get("runname", F.lit(0)).alias("first_run"), F.size("runname").cast("long").alias("runs"), "n", "m")


CSV = "SELECT c_custkey::VARCHAR AS name, c_nationkey::VARCHAR AS first_run, 2::BIGINT AS runs, CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '7' END AS n, '0' AS m FROM customer WHERE c_custkey % 2 = 0"


def references_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A references table read from CSV, blank coding regions filled by the longest reading frame, and its broken rules."""
    path = _folder(spark, "references")
    rows = [(n, a, nt, cds, "FALSE") for n, a, nt, cds in T.REFERENCES] + [("orf", "ccatgaaataacc", None, None, "TRUE"), ("bad", "ACGTACGT", "ACGTAC", "TTT", "FALSE")]
    columns = "ref_seq_name string, ref_seq_alignment string, ref_seq_NT string, ref_seq_coding string, use_longest_ORF string"
    writers.write_csv(spark.createDataFrame(rows, columns).coalesce(1), path)
    refs = readers.read_references(spark, path)
    errors = variants.reference_errors(refs).groupBy("reference_name").agg(F.count("*").alias("errors"))
    return refs.join(errors, "reference_name", "left").select("reference_name", "alignment_seq", "nt_seq", "coding_seq", F.coalesce("errors", F.lit(0)).cast("long").alias("errors"))


_REFERENCE_ROWS = ", ".join(f"('{n}', '{a}', '{nt}', '{cds}', 0::BIGINT)" for n, a, nt, cds in T.REFERENCES)
REFERENCES = f"SELECT * FROM (VALUES {_REFERENCE_ROWS}, ('orf', 'CCATGAAATAACC', 'CCATGAAATAACC', 'ATGAAATAA', 0), ('bad', 'ACGTACGT', 'ACGTAC', 'TTT', 1)) t(reference_name, alignment_seq, nt_seq, coding_seq, errors)"


def paired_reads_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every read cut into a pair of 40 bases from both ends, and merged again."""
    d = T.reads(spark, sf_dir)
    forward = d.select("read_id", F.substring("query_seq", 1, 40).alias("seq"), F.slice("quals", 1, 40).alias("quals"))
    back = S.reverse_complement(F.right("query_seq", F.lit(40)))
    backward = d.select("read_id", back.alias("seq"), F.reverse(F.slice("quals", F.size("quals") - 39, 40)).alias("quals"))
    return umi.merge_pairs(forward, backward, overlap=15, mismatch=0.0).select("read_id", "seq", F.col("overlap").cast("long").alias("overlap"), _sum("quals").alias("quality_sum"))


PAIRS = f"SELECT read_id, query_seq AS seq, (80 - length(query_seq))::BIGINT AS overlap, {_QUALITY} AS quality_sum FROM {_READS}"


def best_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference and strand that every read fits best; every third read is given as its reverse complement."""
    turned = F.when(F.col("read_id").cast("long") % 3 == 1, S.reverse_complement(F.col("query_seq"))).otherwise(F.col("query_seq"))
    hits = explore.best_hits(T.reads(spark, sf_dir).select("read_id", turned.alias("seq")), T.references(spark))
    return hits.select("read_id", "reference_name", "strand")


HITS = f"SELECT read_id, reference_name, CASE WHEN read_id::BIGINT % 3 = 1 THEN '-' ELSE '+' END AS strand FROM ({T.READS})"


def aligned_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads aligned anew, every third given as its reverse complement: place, strand, and bases matched, inserted, deleted and clipped."""
    turned = F.when(F.col("read_id").cast("long") % 3 == 1, S.reverse_complement(F.col("query_seq"))).otherwise(F.col("query_seq"))
    a = align.align_reads(T.reads(spark, sf_dir).select("read_id", turned.alias("seq")), T.references(spark))
    ops = S.cigar_ops(F.col("cigar"))
    bases = lambda op: F.aggregate(F.filter(ops, lambda x: x["op"] == op), F.lit(0), lambda n, x: n + x["n"]).cast("long").alias(op)
    return a.select("read_id", "reference_name", "flag", "ref_start", *map(bases, "MIDS"))


ALIGNED = f"""SELECT read_id, reference_name, CASE WHEN read_id::BIGINT % 3 = 1 THEN 16 ELSE 0 END AS flag, CASE WHEN cigar = '50M' THEN 10 ELSE 0 END AS ref_start,
(length(query_seq) - CASE WHEN cigar LIKE '%I%' THEN 2 ELSE 0 END)::BIGINT AS "M", CASE WHEN cigar LIKE '%I%' THEN 2 ELSE 0 END::BIGINT AS "I", CASE WHEN cigar LIKE '%D%' THEN 3 ELSE 0 END::BIGINT AS "D", 0::BIGINT AS "S" FROM ({T.READS})"""


def global_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bases and gaps of every read aligned end to end with its reference."""
    d = T.reads(spark, sf_dir).join(small(T.references(spark).select("reference_name", F.col("alignment_seq").alias("ref"))), "reference_name")
    a = explore.align_pairs(d.select("read_id", "ref", F.col("query_seq").alias("seq")))
    gaps = lambda c: (F.length(c) - F.length(F.replace(c, F.lit("-"), F.lit("")))).cast("long")
    return a.select("read_id", F.replace("aligned_ref", F.lit("-"), F.lit("")).alias("ref"), F.replace("aligned_seq", F.lit("-"), F.lit("")).alias("seq"), (gaps(F.col("aligned_ref")) - gaps(F.col("aligned_seq"))).alias("net_gaps"))


GLOBAL = f"SELECT read_id, aln AS ref, query_seq AS seq, (length(query_seq) - length(aln))::BIGINT AS net_gaps FROM ({T.READS}) JOIN (VALUES {', '.join(f"('{n}', '{a}')" for n, a, _, _ in T.REFERENCES)}) r(reference_name, aln) USING (reference_name)"


def calls_without_qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substitutions of reads whose qualities are missing: all bases pass."""
    d = T.reads(spark, sf_dir).withColumn("quals", F.lit(None).cast("array<int>"))
    c = variants.call(variants.trim(d, T.references(spark)), MIN_Q)
    return c.select("read_id", "NT_substitutions", "AA_substitutions_nonsynonymous", "avg_quality")


NO_QUALITIES = CALLS.replace(f">= {MIN_Q}", ">= 0") + "SELECT read_id, NT_substitutions, AA_substitutions_nonsynonymous, 0.0::DOUBLE AS avg_quality FROM called"


def path_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per tag and group, which readers take from the paths of a partitioned table."""
    path = _folder(spark, "demuxed")
    writers.write_demuxed(T.reads(spark, sf_dir).select("tag", F.col("reference_name").alias("output_file_barcodes"), "read_id"), path)
    return spark.read.parquet(path).groupBy("tag", "output_file_barcodes").agg(F.count("*").alias("reads"), F.countDistinct("read_id").alias("different"))


PATHS = f"SELECT tag, reference_name AS output_file_barcodes, count(*) AS reads, count(DISTINCT read_id) AS different FROM ({T.READS}) GROUP BY 1, 2"


def screened_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity counts by sample and time without entities of failed barcodes, on the dense grid."""
    d = T.table(spark, sf_dir, "events").select(
        F.concat(F.col("event_type"), F.lit("|"), F.when(F.col("user_id") % 5 == 0, "fail").otherwise((F.col("user_id") % 7).cast("string"))).alias("entity"),
        F.concat(F.lit("t_g"), (F.col("user_id") % 3).cast("string")).alias("tag_group"), F.lit(1).alias("count"),
    )
    layout = spark.createDataFrame([("A", 1, "A", float(k), f"t_g{k}") for k in range(3)], "group string, replicate int, sample_label string, timepoint double, tag_group string")
    return enrich.entity_counts(d, layout, screen=True).select("entity", "timepoint", "c")


SCREENED = """WITH e AS (SELECT event_type || '|' || (user_id % 7)::VARCHAR AS entity, (user_id % 3)::DOUBLE AS timepoint FROM events WHERE user_id % 5 <> 0),
c AS (SELECT entity, timepoint, count(*) AS c FROM e GROUP BY 1, 2)
SELECT entity, timepoint, coalesce(c, 0)::BIGINT AS c FROM (SELECT DISTINCT entity FROM e) a CROSS JOIN (SELECT DISTINCT timepoint FROM e) b LEFT JOIN c USING (entity, timepoint)"""


def exported_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All genotypes exported in every form, and read back as (form, name, content)."""
    forms = explore.export(_geno(spark, sf_dir), _geno_ref(spark), _folder(spark, "export"), "id")
    fasta = lambda form: readers.read_fasta(spark, forms[form]).select(F.lit(form).alias("form"), F.col("id").alias("name"), F.col("seq").alias("content"))
    table = readers.read_csv(spark, forms["genotypes"]).select(F.lit("genotypes").alias("form"), F.col("id").alias("name"), F.col("count").alias("content"))
    cells = readers.read_csv(spark, forms["mutations"]).select(F.lit("mutations").alias("form"), F.concat("wt", "position", "mutation").alias("name"), F.col("n").alias("content"))
    return fasta("nt").unionByName(fasta("aa")).unionByName(fasta("consensus")).unionByName(table).unionByName(cells)


EXPORTED = GENO + f""", codes(codon, aa) AS (VALUES {_CODONS}),
v AS (SELECT p, arg_max(c, n * 10 - strpos('ATGC', c)) AS c FROM (SELECT p, c, sum(n_reads) AS n FROM pts GROUP BY 1, 2) GROUP BY 1)
SELECT 'nt' AS form, id::VARCHAR AS name, s AS content FROM seqs
UNION ALL SELECT 'aa', id::VARCHAR, string_agg(aa, '' ORDER BY k.k) FROM seqs, range(0, 4) k(k) JOIN codes ON codon = substr(s, (k.k * 3 + 1)::INT, 3) GROUP BY id
UNION ALL SELECT 'consensus', 'refA', string_agg(c, '' ORDER BY p) FROM v
UNION ALL SELECT 'genotypes', id::VARCHAR, n_reads::VARCHAR FROM g
UNION ALL SELECT 'mutations', name, sum(n_reads)::BIGINT::VARCHAR FROM muts GROUP BY name"""

_PROTEIN = "".join(S.CODONS[T.REFERENCES[0][3][k : k + 3]] for k in range(0, len(T.REFERENCES[0][3]), 3)).rstrip("*")


def _residue(chain: str, k: int, letter: str) -> str:
    name = next(n for n, one in readers.RESIDUES.items() if one == letter)
    return f"ATOM  {k:5d}  CA  {name} {chain}{100 + k:4d}      11.000  12.000  13.000  1.00  0.00           C"


def structure_residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residues of two chains of a structure file at the positions of the protein: one whole, one cut and changed."""
    path = _folder(spark, "structure.pdb")
    lines = [_residue("A", k, c) for k, c in enumerate(_PROTEIN, 1)] + [_residue("B", k, "W" if k == 5 else c) for k, c in enumerate(_PROTEIN, 1) if k > 2]
    noise = [line.replace(" CA ", " CB ") for line in lines] + ["HETATM 9999  O   HOH A 900      11.000  12.000  13.000", "TER"]
    spark.createDataFrame([(x,) for x in [*lines, *noise]], "value string").write.text(path)
    return explore.structure_positions(readers.read_structure(spark, path), _PROTEIN)


_CHAINS = ", ".join(f"('{c}', {k}::BIGINT, {100 + k}, {str(not (c == 'B' and k == 5)).upper()}, {len(_PROTEIN) - (0 if c == 'A' else 2)})" for c in "AB" for k in range(1 if c == "A" else 3, len(_PROTEIN) + 1))
STRUCTURE = f"SELECT * FROM (VALUES {_CHAINS}) t(chain, position, residue, wt_match, coverage)"


def configuration_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks of a configuration say of one with faults."""
    info = {"a": {"context": "ACNNT", "fasta": "f"}, "b": {"context": "ACT", "fasta": "f"}}
    refs = T.references(spark)
    rows = [("barcodes", str(len(config.barcode_errors(info)) > 0)), ("times", "; ".join(config.timepoint_errors(["1", "x"], ["t_g", "tg", None])))]
    rows += [("coerced", "|".join(str(config.coerce(x)) for x in ("True", "all", "3", "2.5", "x"))), ("contexts", str(config.context_errors(refs, ["GGATCC"]).count()))]
    rows += [("patterns", str(config.pattern_errors(refs, ["NNNN"]).count())), ("groups", str(config.group_errors(T.groups(spark), T.words(spark)).count()))]
    return spark.createDataFrame(rows, "check string, said string")


CONFIGURATION = """SELECT * FROM (VALUES ('barcodes', 'True'), ('times', 'time x is no number; tg is not tag_group'), ('coerced', 'True|all|3|2.5|x'), ('contexts', '1'), ('patterns', '0'), ('groups', '1')) t("check", said)"""

QUERIES = {
    f.__name__: (f, sql)
    for f, sql in (
        (fastq_source, FASTQ), (sam_source, ALIGNMENTS), (bam_source, ALIGNMENTS), (bam_by_reference, BY_REFERENCE), (demuxed_bam, DEMUXED), (fasta_source, FASTA), (msa_source, MSA), (csv_source, CSV),
        (references_source, REFERENCES), (paired_reads_merged, PAIRS), (best_hits, HITS), (aligned_reads, ALIGNED), (global_alignment, GLOBAL), (calls_without_qualities, NO_QUALITIES), (path_columns, PATHS),
        (screened_counts, SCREENED), (exported_genotypes, EXPORTED), (structure_residues, STRUCTURE), (configuration_errors, CONFIGURATION),
    )
}
