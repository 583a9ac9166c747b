"""Mutation calling: alignments to substitutions, indels, amino-acid changes and genotypes.

Coordinates: ``ref_start`` and segments count on the alignment sequence;
positions of calls count on the nucleotide region. Substitutions are formatted
1-based, indels 0-based.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.operators.common import distribution, ranked, small
from strandframe.scratch import Scratch

LATE, EARLY = "alignment starts past trimmed reference start", "alignment ends before trimmed reference end"
MUTATION_COLUMNS = ["NT_substitutions", "NT_substitutions_count", "NT_insertions", "NT_deletions", "NT_insertion_length", "NT_deletion_length"]
AA_COLUMNS = ["AA_substitutions_nonsynonymous", "AA_substitutions_synonymous", "AA_substitutions_nonsynonymous_count"]


def prepare_references(refs: DataFrame) -> DataFrame:
    """References with region coordinates; refs: reference_name, alignment_seq, nt_seq, coding_seq.

    A region found only on the other strand is called there and flipped back.
    """
    up = refs.select("reference_name", *(F.upper(c).alias(c) for c in ("alignment_seq", "nt_seq", "coding_seq")))
    up = up.withColumn("nt_seq", F.coalesce("nt_seq", "alignment_seq"))
    out = up.withColumn("flip", ~F.contains(F.col("alignment_seq"), F.col("nt_seq")))
    out = out.withColumn("region", F.when(F.col("flip"), S.reverse_complement(F.col("nt_seq"))).otherwise(F.col("nt_seq")))
    out = out.withColumn("nt_start", F.expr("position(region, alignment_seq)") - 1).drop("region")
    out = out.withColumn("nt_length", F.length("nt_seq")).withColumn("nt_end", F.col("nt_start") + F.col("nt_length"))
    cds = F.expr("position(coding_seq, nt_seq)") - 1
    return out.withColumn("cds_start", F.when(F.length("coding_seq") > 0, cds)).withColumn("cds_end", F.col("cds_start") + F.length("coding_seq"))


def reference_errors(refs: DataFrame) -> DataFrame:
    """(reference_name, error) of references that break a rule."""
    up = refs.select("reference_name", *(F.upper(c).alias(c) for c in ("alignment_seq", "nt_seq", "coding_seq")))
    back = S.reverse_complement(F.col("nt_seq"))
    has_cds = F.length("coding_seq") > 0
    rules = [
        (F.length("nt_seq").cast("boolean") & ~F.contains(F.col("alignment_seq"), F.col("nt_seq")) & ~F.contains(F.col("alignment_seq"), back), "nt_seq is not in alignment_seq or its reverse complement"),
        (has_cds & ~F.contains(F.col("nt_seq"), F.col("coding_seq")), "coding_seq is not in nt_seq"),
        (has_cds & (F.length("coding_seq") % 3 != 0), "length of coding_seq is not a multiple of 3"),
        (has_cds & F.col("coding_seq").rlike("[^ATGCN]"), "coding_seq has a character other than A, T, G, C, N"),
    ]
    found = F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), text) for test, text in rules)), lambda x: x.isNotNull())
    return up.select("reference_name", F.explode(found).alias("error"))


def trim(alignments: DataFrame, refs: DataFrame, aa: bool = True, allow_frameshift: bool = True, screen_failed: bool = False) -> DataFrame:
    """Alignments cut to the nucleotide region, in its orientation.

    Adds ref, query (gapped), quals, insertions (pos, seq), deletions (pos, len)
    and failure_reason, failure_index (null where the read is usable).
    """
    rows = alignments.filter(~F.coalesce(F.contains(F.col("bc"), F.lit("fail")), F.lit(False))) if screen_failed else alignments
    ops = rows.filter(F.coalesce(F.col("flag").bitwiseAND(4) == 0, F.lit(True))).withColumn("ops", S.cigar_ops(F.col("cigar")))
    cut = ops.withColumn("query_seq", S.aligned_query(F.upper("query_seq"), F.col("ops"))).withColumn("quals", S.aligned_quals(F.col("quals"), F.col("ops")))
    cut = cut.withColumn("segs", S.cigar_segments(F.col("ops"))).join(small(prepare_references(refs)), "reference_name")
    span = F.aggregate("segs", F.lit(0), lambda a, x: a + F.when(x["op"] != "I", x["n"]).otherwise(0))
    cut = cut.withColumn("ref_end", F.col("ref_start") + span)
    at, length = lambda x: F.col("ref_start") + x["r"], F.col("nt_length")
    ins = F.filter("segs", lambda x: (x["op"] == "I") & (at(x) >= F.col("nt_start")) & (at(x) < F.col("nt_end")))
    dels = F.filter("segs", lambda x: (x["op"] == "D") & (at(x) + x["n"] >= F.col("nt_start")) & (at(x) < F.col("nt_end")))
    off, query = F.col("nt_start") - F.col("ref_start"), F.col("query_seq")
    cut = cut.withColumn("insertions", F.transform(ins, lambda x: F.struct((at(x) - F.col("nt_start")).alias("pos"), F.substring(query, x["q"] + 1, x["n"]).alias("seq"))))
    cut = cut.withColumn("deletions", F.transform(dels, lambda x: F.struct((at(x) - F.col("nt_start")).alias("pos"), x["n"].alias("len"))))
    region = lambda c: F.substring(c, off + 1, length)
    cut = cut.withColumn("query", region(S.gapped_query(query, F.col("segs"))))
    cut = cut.withColumn("quals", F.when(F.col("quals").isNotNull() & (off >= 0), F.slice(S.gapped_quals(F.col("quals"), F.col("segs")), F.greatest(off, F.lit(0)) + 1, length)))
    flip = F.col("flip")
    cut = cut.withColumn("ref", F.col("nt_seq")).withColumn("query", F.when(flip, S.reverse_complement(F.col("query"))).otherwise(F.col("query")))
    cut = cut.withColumn("quals", F.when(flip, F.reverse("quals")).otherwise(F.col("quals")))
    turned_ins = F.reverse(F.transform("insertions", lambda x: F.struct((length - x["pos"]).alias("pos"), S.reverse_complement(x["seq"]).alias("seq"))))
    turned_del = F.reverse(F.transform("deletions", lambda x: F.struct((length - x["pos"] - x["len"]).alias("pos"), x["len"].alias("len"))))
    cut = cut.withColumn("insertions", F.when(flip, turned_ins).otherwise(F.col("insertions")))
    cut = cut.withColumn("deletions", F.when(flip, turned_del).otherwise(F.col("deletions")))
    reason = F.when(F.col("ref_start") > F.col("nt_start"), LATE).when(F.col("ref_end") < F.col("nt_end"), EARLY)
    index = F.lit(None).cast("int")
    if aa and not allow_frameshift:
        lo, hi = F.col("cds_start"), F.col("cds_end")
        bad_ins = F.filter("insertions", lambda x: (F.length(x["seq"]) % 3 != 0) & (x["pos"] >= lo) & (x["pos"] < hi))
        bad_del = F.filter("deletions", lambda x: (x["len"] % 3 != 0) & (x["pos"] + x["len"] > lo) & (x["pos"] < hi))
        shift = F.when(F.size(bad_ins) > 0, "frameshift insertion").when(F.size(bad_del) > 0, "frameshift deletion")
        index = F.when(reason.isNull() & (F.size(bad_ins) > 0), F.get(bad_ins, F.lit(0))["pos"]).when(reason.isNull(), F.get(bad_del, F.lit(0))["pos"])
        reason = F.coalesce(reason, shift)
    return cut.withColumn("failure_reason", reason).withColumn("failure_index", index)


def _touched_codons() -> Column:
    """Codons that an indel touches: from a deletion's first to its last, and the one an insertion splits."""
    lo, hi = F.col("cds_start"), F.col("cds_end")
    ins = F.transform(F.filter("insertions", lambda x: (x["pos"] >= lo) & (x["pos"] < hi) & ((x["pos"] - lo) % 3 != 0)), lambda x: F.floor((x["pos"] - lo) / 3))
    inside = F.filter("deletions", lambda x: ((x["pos"] >= lo) & (x["pos"] < hi)) | ((x["pos"] + x["len"] >= lo) & (x["pos"] + x["len"] < hi)))
    dels = F.flatten(F.transform(inside, lambda x: F.sequence(((x["pos"] - lo) / 3).cast("long"), ((x["pos"] + x["len"] - lo) / 3).cast("long"))))
    return F.concat(ins, dels)


def call(trimmed: DataFrame, min_quality: int = 0, aa: bool = True, keep_failed: bool = False) -> DataFrame:
    """Usable reads with nt (pos, wt, mut), aa_changes, the genotype columns and the mean quality.

    keep_failed: unusable reads stay, so that one pass gives calls and failures;
    their call columns mean nothing.
    """
    rows = trimmed if keep_failed else trimmed.filter("failure_reason is null")
    q = lambda i: F.coalesce(F.get("quals", i), F.lit(1 << 20))
    # Bases are compared as they are; only those that differ become structs. A read equal to its reference is done at once.
    none = F.array().cast("array<struct<pos:int,wt:string,mut:string>>")
    pairs = F.zip_with(F.split("ref", ""), F.split("query", ""), lambda r, m: F.when((r != m) & (m != "-"), F.concat(r, m)))
    spots = F.transform(pairs, lambda x, i: F.when(x.isNotNull(), F.struct(i.alias("pos"), F.left(x, F.lit(1)).alias("wt"), F.right(x, F.lit(1)).alias("mut"))))
    found = F.filter(spots, lambda x: x.isNotNull() & (q(x["pos"]) >= min_quality))
    rows = rows.withColumn("nt", F.when(F.col("ref") == F.col("query"), none).otherwise(found))
    rows = rows.withColumn("NT_substitutions", F.array_join(F.transform("nt", lambda x: F.concat(x["wt"], (x["pos"] + 1).cast("string"), x["mut"])), ", "))
    rows = rows.withColumn("NT_substitutions_count", F.size("nt").cast("long"))
    rows = rows.withColumn("NT_insertions", F.array_join(F.transform("insertions", lambda x: F.concat(x["pos"].cast("string"), F.lit("ins"), x["seq"])), ", "))
    rows = rows.withColumn("NT_deletions", F.array_join(F.transform("deletions", lambda x: F.concat(x["pos"].cast("string"), F.lit("del"), x["len"].cast("string"))), ", "))
    rows = rows.withColumn("NT_insertion_length", F.aggregate("insertions", F.lit(0), lambda a, x: a + F.length(x["seq"])).cast("long"))
    rows = rows.withColumn("NT_deletion_length", F.aggregate("deletions", F.lit(0), lambda a, x: a + x["len"]).cast("long"))
    total = F.aggregate("quals", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("avg_quality", F.when(F.size("quals") > 0, total / F.size("quals")).otherwise(F.lit(0.0)))
    if not aa:
        return rows
    lo, hi = F.col("cds_start"), F.col("cds_end")
    within = F.filter("nt", lambda x: (x["pos"] >= lo) & (x["pos"] < hi))
    codons = F.array_except(F.array_distinct(F.transform(within, lambda x: F.floor((x["pos"] - lo) / 3))), _touched_codons())
    good = F.filter(codons, lambda c: (q(lo + 3 * c) >= min_quality) & (q(lo + 3 * c + 1) >= min_quality) & (q(lo + 3 * c + 2) >= min_quality))
    at = lambda s, c: S.translate_codon(F.substring(s, (lo + 3 * c + 1).cast("int"), F.lit(3)))
    made = F.transform(good, lambda c: F.struct(c.cast("int").alias("pos"), at(F.col("ref"), c).alias("wt"), at(F.col("query"), c).alias("mut")))
    rows = rows.withColumn("aa_calls", F.coalesce(made, F.array().cast("array<struct<pos:int,wt:string,mut:string>>")))
    rows = rows.withColumn("aa_changes", F.filter("aa_calls", lambda x: x["wt"] != x["mut"]))
    rows = rows.withColumn("AA_substitutions_nonsynonymous", F.array_join(F.transform("aa_changes", lambda x: F.concat(x["wt"], (x["pos"] + 1).cast("string"), x["mut"])), ", "))
    same = F.filter("aa_calls", lambda x: x["wt"] == x["mut"])
    rows = rows.withColumn("AA_substitutions_synonymous", F.array_join(F.transform(same, lambda x: F.concat(x["wt"], (x["pos"] + 1).cast("string"))), ", "))
    return rows.withColumn("AA_substitutions_nonsynonymous_count", F.size("aa_changes").cast("long"))


def failures(trimmed: DataFrame) -> DataFrame:
    return trimmed.filter("failure_reason is not null").select(F.col("read_id").alias("seq_ID"), "reference_name", "failure_reason", "failure_index")


def genotypes(called: DataFrame, by: list[str] | None = None, aa: bool = True) -> DataFrame:
    """Reads condensed to genotypes, ranked per reference.

    The most abundant comes first, then the one with fewer substitutions, then
    by text; the genotype without changes is moved to the front and named
    wildtype, the others are counted from 1. best_read has the highest mean quality.
    """
    by = by or ["reference_name"]
    cols = MUTATION_COLUMNS + (AA_COLUMNS if aa else [])
    best = F.max_by("read_id", F.struct(F.col("avg_quality"), F.col("read_id")))
    made = called.groupBy(*by, *cols).agg(F.count("*").alias("count"), best.alias("best_read"))
    wild = (F.col("NT_substitutions") == "") & (F.col("NT_insertions") == "") & (F.col("NT_deletions") == "")
    # Ranking reads the genotypes three times; the calls behind them are made once.
    scratch = Scratch(called.sparkSession, "genotypes")
    made = scratch.save(made.withColumn("wild", wild))
    coarse = [~F.col("wild"), -F.col("count"), F.col("NT_substitutions_count"), F.substring("NT_substitutions", 1, 5)]
    placed = ranked(made, by, coarse, [F.col(c) for c in ("NT_substitutions", "NT_insertions", "NT_deletions", *cols)], "place")
    # The wild type is alone in front, so one small row per group says whether the others start at 1.
    has_wild = scratch.save(made.filter("wild").select(*by, F.lit(1).alias("__w")).distinct())
    placed = placed.join(small(has_wild), by, "left").withColumn("genotype_rank", F.col("place") - F.coalesce("__w", F.lit(0)))
    name = F.when(F.col("wild"), "wildtype").otherwise(F.col("genotype_rank").cast("string"))
    return placed.withColumn("genotype_ID", name).drop("wild", "place", "__w")


def seq_ids(called: DataFrame, condensed: DataFrame, by: list[str] | None = None, aa: bool = True) -> DataFrame:
    """(seq_ID, reference_name, genotype_ID) of every read."""
    cols = [*(by or ["reference_name"]), *MUTATION_COLUMNS, *(AA_COLUMNS if aa else [])]
    keep = ["label_barcodes"] if "label_barcodes" in called.columns else []
    # Written once, their size is known: few genotypes are sent to the reads, of which those of one genotype are not shuffled into one task.
    named = Scratch(called.sparkSession, "named").save(condensed.select(*cols, "genotype_ID"))
    return called.join(small(named), cols).select(F.col("read_id").alias("seq_ID"), *(by or ["reference_name"]), "genotype_ID", *keep)


def tidy_counts(called: DataFrame, refs: DataFrame, level: str = "NT", by: list[str] | None = None) -> DataFrame:
    """Counts of every position and letter: wt, position (1-based), mutation, total_count, proportion_of_seqs.

    The wild-type letter's cells are null. Letters outside the alphabet are not counted.
    """
    by = by or ["reference_name"]
    alphabet, col = (S.NTS, "nt") if level == "NT" else (S.AAS, "aa_changes")
    seen = called.select(*by, F.explode(col).alias("m")).groupBy(*by, F.col("m.pos").alias("pos"), F.col("m.mut").alias("mutation")).agg(F.count("*").alias("c"))
    groups = called.groupBy(*by).agg(F.count("*").alias("seqs"))
    prepared = prepare_references(refs)
    text = F.col("nt_seq") if level == "NT" else S.translate_nt(F.col("coding_seq"))
    spine = prepared.select("reference_name", F.posexplode(S.chars(text)).alias("pos", "wt")).withColumn("mutation", F.explode(F.array(*(F.lit(a) for a in alphabet))))
    dense = small(groups).join(spine, "reference_name").join(seen, [*by, "pos", "mutation"], "left")
    count = F.when(F.col("wt") != F.col("mutation"), F.coalesce("c", F.lit(0)))
    return dense.select(
        *by, F.col("wt"), (F.col("pos") + 1).cast("long").alias("position"), "mutation", count.alias("total_count"), (count / F.col("seqs")).alias("proportion_of_seqs")
    )


def mutation_distribution(called: DataFrame, level: str = "NT", by: list[str] | None = None) -> DataFrame:
    """Histogram of mutations per read."""
    col = "NT_substitutions_count" if level == "NT" else "AA_substitutions_nonsynonymous_count"
    return distribution(called, col, by or ["reference_name"])


def genotype_alignments(trimmed: DataFrame, called: DataFrame, condensed: DataFrame, n: int, ids: list[str] | None = None) -> DataFrame:
    """Three text lines (reference, match, query) for the n most abundant genotypes, the wild type apart, and for ids."""
    chosen = condensed.filter((F.col("genotype_rank") <= n) | (F.col("genotype_ID").isin(ids or [])))
    chosen = Scratch(trimmed.sparkSession, "chosen").save(chosen.select("reference_name", "genotype_ID", "genotype_rank", "count", F.col("best_read").alias("read_id")))
    rows = small(chosen).join(trimmed.select("read_id", "reference_name", "ref", "query"), ["read_id", "reference_name"])
    return rows.select("reference_name", "genotype_ID", "genotype_rank", "count", "ref", S.match_line(F.col("ref"), F.col("query")).alias("match"), "query")
