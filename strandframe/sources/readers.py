"""Readers of sequence files and layout tables; every one names its schema."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.sources.ranges import SPLIT, BamSource, FastqReader, FastqSource, load, opened

FASTQ_ENDINGS = FastqReader.endings

ALIGNMENTS = "read_id string, tag string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string, nm int"


def find_fastqs(root: str, names: list[str], subfolder: str = "", select: str = "") -> list[str]:
    """FASTQ files: names are files (each found exactly once below root) or folders, scanned in their subfolders.

    root is a local path or an address of any store that Arrow reaches; only names are listed.
    """
    store, inner = opened(root)
    base = inner.rstrip("/") + "/"
    below = [(i.path.removeprefix(base), i.is_file) for i in store.get_file_info(fs.FileSelector(base, recursive=True))]
    full = lambda paths: [f"{root.rstrip('/')}/{p}" for p in sorted(paths)]
    called = lambda path, name: f"/{path}".endswith(f"/{name.strip('/')}")
    out = []
    if all(n.endswith(FASTQ_ENDINGS) for n in names):
        for n in names:
            hits = [p for p, file in below if file and called(p, n)]
            if len(hits) != 1:
                raise FileNotFoundError(f"{len(hits)} files named {n} below {root}")
            out += full(hits)
        return out
    for n in names:
        folders = [p for p, file in below if not file and called(p, n)]
        if len(folders) != 1:
            raise FileNotFoundError(f"{len(folders)} folders named {n} below {root}")
        for sub in [s.strip() for s in subfolder.split(",") if s.strip()] or ["."]:
            inside = [folders[0]] if sub == "." else [p for p, file in below if not file and p.startswith(f"{folders[0]}/") and called(p, sub)]
            files = [p for p, file in below if file and p.rpartition("/")[0] in inside and p.endswith(FASTQ_ENDINGS) and (not select or p.rpartition("/")[2] == select)]
            if not files:
                raise FileNotFoundError(f"no FASTQ files in {n}/{sub}")
            out += full(files)
    return out


def choose_source(tag: dict) -> str:
    """Which of a tag's inputs counts: read pairs, then run names, then a project."""
    for key in ("fwdReads", "runname", "bs_project_ID"):
        if tag.get(key):
            return key
    raise ValueError("a tag needs fwdReads, runname or bs_project_ID")


def read_fastq(spark: SparkSession, paths: str | list[str], split: int = SPLIT) -> DataFrame:
    """(read_id, description, seq, quals) of files or folders of four-line records; plain files are split by bytes."""
    return load(spark, FastqSource, paths, split)


def read_bam(spark: SparkSession, paths: str | list[str], tag: str | None = None, reference: str | None = None, split: int = SPLIT) -> DataFrame:
    """Alignments of BAM files or folders in the alignment schema; reference picks one. Files are split by bytes.

    A filter on reference_name goes to the source: files with an index are read only where that reference is.
    """
    rows = load(spark, BamSource, paths, split).withColumn("tag", F.lit(tag).cast("string"))
    rows = rows.filter(F.col("reference_name") == reference) if reference else rows
    return rows.select(*(f.split()[0] for f in ALIGNMENTS.split(", ")))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(id, description, seq) of records of any number of lines."""
    raw = spark.read.option("lineSep", ">").text(paths).filter(F.length(F.trim("value")) > 0)
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    head = F.split(F.get(lines, F.lit(0)), " ", 2)
    return raw.select(F.get(head, F.lit(0)).alias("id"), F.get(head, F.lit(1)).alias("description"), F.array_join(F.slice(lines, F.lit(2), F.size(lines)), "").alias("seq")).filter("id != ''")


def read_msa(spark: SparkSession, path: str, alphabet: str) -> DataFrame:
    """(id, features, seq) of an alignment: headers ``ID__feature:value``; columns with a dot anywhere become gaps."""
    rows = read_fasta(spark, path).withColumn("seq", F.upper("seq"))
    rows = rows.filter(~F.col("seq").rlike(f"[^{alphabet.replace('-', '')}.\\-]"))
    parts = F.split("id", "__")
    rows = rows.select(F.get(parts, F.lit(0)).alias("id"), F.str_to_map(F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "__"), F.lit("__"), F.lit(":")).alias("features"), "seq")
    dotted = rows.select(F.posexplode(F.regexp_extract_all("seq", F.lit("."), F.lit(0))).alias("p", "c")).filter("c = '.'").agg(F.collect_set("p").alias("blank"))
    letters = F.regexp_extract_all("seq", F.lit("."), F.lit(0))
    blanked = F.array_join(F.transform(letters, lambda c, i: F.when(F.array_contains("blank", i), "-").otherwise(c)), "")
    return rows.crossJoin(F.broadcast(dotted)).withColumn("seq", blanked).drop("blank")


def read_sam(spark: SparkSession, paths: str | list[str], tag: str | None = None, reference: str | None = None) -> DataFrame:
    """Alignments of SAM text in the alignment schema; reference picks one."""
    fields = F.split("value", "\t")
    rows = spark.read.text(paths).filter(~F.col("value").startswith("@")).select(fields.alias("f"), "value")
    at = lambda k: F.get("f", F.lit(k))
    quals = F.when(at(10) != "*", F.transform(F.regexp_extract_all(at(10), F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c) - 33))
    bc, nm = F.regexp_extract("value", r"\tBC:Z:([^\t]*)", 1), F.regexp_extract("value", r"\tNM:i:(\d+)", 1)
    out = rows.select(
        at(0).alias("read_id"), F.lit(tag).cast("string").alias("tag"), at(2).alias("reference_name"), (at(3).cast("int") - 1).alias("ref_start"), at(1).cast("int").alias("flag"),
        at(5).alias("cigar"), at(9).alias("query_seq"), quals.alias("quals"), F.when(bc != "", bc).alias("bc"), F.when(nm != "", nm.cast("int")).alias("nm"),
    )
    return out.filter(F.col("reference_name") == reference) if reference else out


# Three-letter names of the amino acids and their letters.
RESIDUES = dict(zip("ALA CYS ASP GLU PHE GLY HIS ILE LYS LEU MET ASN PRO GLN ARG SER THR VAL TRP TYR".split(), "ACDEFGHIKLMNPQRSTVWY", strict=True))


def read_structure(spark: SparkSession, path: str) -> DataFrame:
    """(chain, residue, insertion, aa): the residues of a PDB or mmCIF file, by their alpha carbons; X for unknown ones."""
    lines = spark.read.text(path).filter(F.col("value").startswith("ATOM"))
    if path.endswith((".cif", ".cif.gz")):
        f = F.split(F.trim("value"), r"\s+")
        atom, name, chain, residue, insertion = (F.get(f, F.lit(k)) for k in (3, 5, 18, 16, 9))
        insertion = F.when(insertion.isin("?", "."), "").otherwise(insertion)
    else:
        atom, name, chain, residue, insertion = (F.trim(F.substring("value", at, n)) for at, n in ((13, 4), (18, 3), (22, 1), (23, 4), (27, 1)))
    letters = F.create_map(*(F.lit(x) for kv in RESIDUES.items() for x in kv))
    rows = lines.filter(atom == "CA").select(chain.alias("chain"), residue.cast("int").alias("residue"), insertion.alias("insertion"), F.coalesce(F.element_at(letters, name), F.lit("X")).alias("aa"))
    # Other places of an atom and other models repeat a residue.
    return rows.groupBy("chain", "residue", "insertion").agg(F.min("aa").alias("aa"))


def read_csv(spark: SparkSession, path: str, tag: str | None = None, required: tuple[str, ...] = (), defaults: dict | None = None, lists: tuple[str, ...] = ()) -> DataFrame:
    """A layout table as strings: byte order mark dropped, rows of one tag, blanks filled, lists split."""
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    df = df.toDF(*(c.removeprefix("﻿") for c in df.columns))
    if lost := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns missing in {path}: {', '.join(lost)}")
    if tag is not None and "tag" in df.columns:
        df = df.filter(F.col("tag") == tag)
    for c, v in (defaults or {}).items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(str(v))) if c in df.columns else F.lit(str(v)))
    for c in lists:
        if c in df.columns:
            df = df.withColumn(c, F.split(c, r"\s*(?:,|__)\s*"))
    return df


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """References table: reference_name, alignment_seq, nt_seq, coding_seq, structure_file; upper case.

    use_longest_ORF fills a blank coding region from the nucleotide region.
    """
    from strandframe.functions.seq import longest_orf

    df = read_csv(spark, path, required=("ref_seq_name", "ref_seq_alignment"), defaults={"use_longest_ORF": "FALSE"})
    col = lambda c: F.upper(F.col(c)) if c in df.columns else F.lit(None).cast("string")
    nt = F.coalesce(col("ref_seq_NT"), col("ref_seq_alignment"))
    orf = F.when(F.upper("use_longest_ORF") == "TRUE", longest_orf(nt))
    return df.select(
        F.col("ref_seq_name").alias("reference_name"), col("ref_seq_alignment").alias("alignment_seq"), nt.alias("nt_seq"), F.coalesce(col("ref_seq_coding"), orf, F.lit("")).alias("coding_seq"),
        (F.col("structure_file") if "structure_file" in df.columns else F.lit(None).cast("string")).alias("structure_file"),
    )


def read_groups(spark: SparkSession, path: str, types: list[str]) -> DataFrame:
    """Barcode groups in file order: group_order, group, members (blank cells are wildcards)."""
    df = read_csv(spark, path, required=("barcode_group",))
    have = [t for t in types if t in df.columns]
    pairs = F.array(*(F.struct(F.lit(t).alias("k"), F.col(t).alias("v")) for t in have))
    members = F.map_from_entries(F.filter(pairs, lambda x: x["v"].isNotNull()))
    return df.select(F.monotonically_increasing_id().alias("group_order"), F.col("barcode_group").alias("group"), members.alias("members"))
