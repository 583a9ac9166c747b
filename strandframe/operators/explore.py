"""Selecting, tracing and summarising: what a viewer asks of the tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandframe.functions import seq as S
from strandframe.operators.align import Scores, align_reads, pairs_aligned
from strandframe.operators.common import small
from strandframe.operators.diversity import apply_genotype, consensus, identities
from strandframe.sources.writers import write_csv, write_fasta


def select_genotypes(
    df: DataFrame, reference: str | None = None, ranges: dict[str, tuple[float, float]] | None = None,
    labels: dict[str, list[str]] | None = None, exclude_indels: bool = False,
) -> DataFrame:
    """Genotypes of a reference within inclusive ranges and with wanted labels, without indels if asked."""
    out = df.filter(F.col("reference_name") == reference) if reference else df
    for col, (lo, hi) in (ranges or {}).items():
        out = out.filter(F.col(col).between(lo, hi))
    for col, wanted in (labels or {}).items():
        out = out.filter(F.col(col).isin(wanted))
    if exclude_indels:
        empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
        out = out.filter(empty("NT_insertions") & empty("NT_deletions"))
    return out


def count_sequences(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sequences behind the rows: the sum of count where there is one, else the rows."""
    n = F.sum("count") if "count" in df.columns else F.count("*")
    return df.groupBy(*(by or [])).agg(n.cast("long").alias("sequences"))


def read_summary(reads: DataFrame, by: list[str]) -> DataFrame:
    """Number, bases, mean and median length, N50 and mean quality of reads (seq, quals)."""
    rows = reads.select(*by, F.length("seq").cast("long").alias("n"), F.aggregate("quals", F.lit(0).cast("long"), lambda a, x: a + x).alias("q"))
    per = rows.groupBy(*by, "n").agg(F.count("*").alias("k"))
    longest = Window.partitionBy(*by).orderBy(F.desc("n"))
    cut = per.withColumn("seen", F.sum(F.col("n") * F.col("k")).over(longest)).withColumn("all", F.sum(F.col("n") * F.col("k")).over(Window.partitionBy(*by)))
    n50 = cut.filter(F.col("seen") * 2 >= F.col("all")).groupBy(*by).agg(F.max("n").alias("n50"))
    base = rows.groupBy(*by).agg(
        F.count("*").alias("reads"), F.sum("n").alias("bases"), F.avg("n").alias("mean_length"), F.percentile("n", F.lit(0.5)).alias("median_length"), (F.sum("q") / F.sum("n")).alias("mean_quality")
    )
    return base.join(n50, by)


def trace_reads(alignments: DataFrame, ids: DataFrame, refs: DataFrame, genotype: str | None = None, label: str | None = None) -> DataFrame:
    """The reads behind a genotype or a label, spelled along the reference with insertions in lower case.

    alignments: read_id, reference_name, ref_start, cigar, query_seq; ids: seq_ID, reference_name, genotype_ID, label_barcodes.
    """
    wanted = ids.filter(F.col("genotype_ID") == genotype) if genotype is not None else ids
    wanted = wanted.filter(F.col("label_barcodes") == label) if label is not None else wanted
    chosen = wanted.select(F.col("seq_ID").alias("read_id"), "reference_name").distinct()
    rows = alignments.join(chosen, ["read_id", "reference_name"], "left_semi").join(small(refs.select("reference_name", "alignment_seq")), "reference_name")
    ops = S.cigar_ops(F.col("cigar"))
    rows = rows.withColumn("query", S.aligned_query(F.col("query_seq"), ops)).withColumn("segs", S.cigar_segments(ops))
    text = F.concat(F.repeat(F.lit("-"), F.col("ref_start")), S.marked_query(F.col("query"), F.col("segs")))
    return rows.select("read_id", "reference_name", text.alias("aligned"))


def encode(seq: Column, alphabet: str) -> Column:
    """Letters as their places in the alphabet; -1 for others."""
    return F.transform(S.chars(seq), lambda c: F.instr(F.lit(alphabet), c) - 1)


def decode(codes: Column, alphabet: str) -> Column:
    return F.array_join(F.transform(codes, lambda i: F.substring(F.lit(alphabet), i + 1, F.lit(1))), "")


def structure_positions(structure: DataFrame, protein: str) -> DataFrame:
    """(chain, position, residue, wt_match, coverage): residues at the positions (from 1) of a protein, each chain aligned end to end.

    structure: chain, residue, insertion, aa. coverage counts a chain's residues that have a position.
    """
    order = F.array_sort(F.collect_list(F.struct("residue", "insertion", "aa")))
    chains = structure.groupBy("chain").agg(order.alias("r")).withColumn("seq", F.array_join(F.transform("r", lambda x: x["aa"]), "")).withColumn("ref", F.lit(protein))
    pairs = F.arrays_zip(S.chars(F.col("aligned_ref")).alias("p"), S.chars(F.col("aligned_seq")).alias("q"))
    cells = align_pairs(chains).select("chain", "r", F.posexplode(pairs).alias("k", "x"))
    upto = Window.partitionBy("chain").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    at = lambda c: F.sum((F.col(c) != "-").cast("int")).over(upto)
    rows = cells.select("chain", at("x.p").cast("long").alias("position"), F.get("r", at("x.q") - 1)["residue"].alias("residue"), "x.p", "x.q").filter("p <> '-' and q <> '-'")
    return rows.select("chain", "position", "residue", (F.col("p") == F.col("q")).alias("wt_match"), F.count("*").over(Window.partitionBy("chain")).cast("int").alias("coverage"))


def export(genotypes: DataFrame, refs: DataFrame, path: str, name: str = "genotype_ID") -> dict[str, str]:
    """A selection of genotypes in all the forms that a viewer offers, below one folder; returns the paths by form.

    genotypes: reference_name, name, count, points and any columns; refs: reference_name, seq.
    genotypes (CSV), nt and aa (FASTA), consensus (FASTA, weighed by count), mutations (CSV, every changed letter).
    """
    out = {form: f"{path.rstrip('/')}/{form}" for form in ("genotypes", "nt", "aa", "consensus", "mutations")}
    spelled = genotypes.join(small(refs.select("reference_name", "seq")), "reference_name").withColumn("seq", apply_genotype(F.col("seq"), F.col("points")))
    plain = F.replace("seq", F.lit("-"), F.lit(""))
    counts = identities(genotypes, refs)
    write_csv(genotypes.drop("points"), out["genotypes"])
    write_fasta(spelled.select(F.col(name).alias("id"), plain.alias("seq")), out["nt"])
    write_fasta(spelled.select(F.col(name).alias("id"), S.translate_nt(plain).alias("seq")), out["aa"])
    write_fasta(consensus(counts).select(F.col("reference_name").alias("id"), F.replace("consensus", F.lit("-"), F.lit("")).alias("seq")), out["consensus"])
    write_csv(counts.filter("wt <> mutation and n > 0"), out["mutations"])
    return out


def on_structure(profile: DataFrame, positions: DataFrame, least_identity: float = 0.95) -> DataFrame:
    """Position frequencies on the residues of the best chain.

    positions: chain, position, residue, wt_match, coverage. The chain of the highest
    identity, then coverage, is used if it is identical enough.
    """
    chains = positions.groupBy("chain").agg(F.avg(F.col("wt_match").cast("double")).alias("identity"), F.max("coverage").alias("coverage"))
    best = chains.filter(F.col("identity") >= least_identity).orderBy(F.desc("identity"), F.desc("coverage"), "chain").limit(1)
    return positions.join(F.broadcast(best.select("chain")), "chain").join(profile, "position", "left").select("chain", "residue", "position", F.coalesce("frequency", F.lit(0.0)).alias("frequency"))


def align_pairs(df: DataFrame, ref: str = "ref", seq: str = "seq", match: int = 2, mismatch: int = -4, opening: int = -4, extend: int = -2, local: bool = False) -> DataFrame:
    """Affine pairwise alignment of sequences: score, aligned_ref, aligned_seq.

    The first base of a gap costs opening + extend, every further one extend.
    Many pairs are worked off at once, in a band that is as wide as they need; null sequences count as empty.
    """
    scores = Scores(match, -mismatch, ((-opening, -extend),), 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            done = pairs_aligned([a or "" for a in pdf[ref]], [b or "" for b in pdf[seq]], scores, local)
            yield pdf.assign(score=[d[0] for d in done], aligned_ref=[d[1] for d in done], aligned_seq=[d[2] for d in done])

    extra = [T.StructField("score", T.LongType()), T.StructField("aligned_ref", T.StringType()), T.StructField("aligned_seq", T.StringType())]
    return df.mapInPandas(run, T.StructType([*df.schema.fields, *extra]))


def best_hits(reads: DataFrame, refs: DataFrame, k: int = 11) -> DataFrame:
    """(read_id, reference_name, strand, score, aligned_ref, aligned_seq): the reference and strand of the best local alignment of each read.

    reads: read_id, seq; refs: reference_name, alignment_seq. Ties go to the first
    name, then the forward strand. Every read has a row; the reference of one in which no base aligns is null.
    """
    hits = align_reads(reads.select("read_id", "seq"), refs, Scores(gaps=((4, 2),), end_bonus=0), k)
    rows = hits.join(small(refs.select("reference_name", F.upper("alignment_seq").alias("ref"))), "reference_name", "left")
    ops = S.cigar_ops(F.col("cigar"))
    rows = rows.withColumn("query", S.aligned_query(F.col("query_seq"), ops)).withColumn("segs", S.cigar_segments(ops))
    sides = S.both_sides(F.col("ref"), F.col("query"), F.col("ref_start"), F.col("segs"))
    mapped = F.col("flag") != 4
    return rows.select("read_id", F.when(mapped, F.col("reference_name")).alias("reference_name"), F.when(mapped, F.when(F.col("flag") == 16, "-").otherwise("+")).alias("strand"), F.coalesce("score", F.lit(0)).cast("long").alias("score"), *sides)


def align(a: str, b: str, match: int, mismatch: int, opening: int, extend: int, local: bool) -> tuple[int, str, str]:
    return pairs_aligned([a], [b], Scores(match, -mismatch, ((-opening, -extend),), 0), local)[0]
