"""Golden cases worked out by hand, properties, and plain versions of what SQL cannot express."""

import gzip
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe import config
from strandframe.functions import seq as S
from strandframe.operators import common, demux, distances, diversity, enrich, rates, sampling, stats, umi, variants
from strandframe.plans import registry, synthetic
from strandframe.sources import readers, writers
from strandframe.streaming import live


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("v")).first().v


def test_g1_g2_cigar(spark):
    ref, seq = "NNACGACTGGATT", "ACGTTACGGA"
    refs = spark.createDataFrame([("r", ref, ref, "")], "reference_name string, alignment_seq string, nt_seq string, coding_seq string")
    row = spark.createDataFrame([("a", "t", "r", 2, 0, "3M2I2M1D3M", seq, [30] * 10, None)], readers.ALIGNMENTS.removesuffix(", nm int"))
    segs = S.cigar_segments(S.cigar_ops(F.col("cigar")))
    d = row.withColumn("s", segs)
    got = d.select(
        S.covered_reference(F.lit(ref), F.col("ref_start"), F.col("s")).alias("ref"), S.gapped_query(F.col("query_seq"), F.col("s")).alias("q"),
        S.gapped_reference(F.lit(ref), F.col("ref_start"), F.col("s")).alias("g"), S.marked_query(F.col("query_seq"), F.col("s")).alias("m"),
    ).first()
    assert tuple(got) == ("ACGACTGGA", "ACGAC-GGA", "ACG--ACGGA", "ACGttAC-GGA")
    cut = refs.withColumn("nt_seq", F.lit("ACGACTGGA"))
    t = variants.trim(row, cut, aa=False).first()
    assert [tuple(x) for x in t.insertions] == [(3, "TT")] and [tuple(x) for x in t.deletions] == [(5, 1)] and t.quals == [30] * 5 + [0] + [30] * 3


def test_g3_g13_distribution(spark):
    d = spark.createDataFrame([(0,), (0,), (0,), (2,)], "n int")
    assert [(r.total, r.proportion, r.cumulative) for r in common.distribution(d, "n").orderBy("x").collect()] == [(3, 0.75, 0.75), (0, 0, 0.75), (1, 0.25, 1)]
    half = spark.createDataFrame([("a", 0, 1), ("a", 1, 1)], "g string, x int, total long")
    assert stats.distribution_median(half, ["g"]).first().median == 0
    assert common.distribution(d.limit(0), "n").count() == 0


def test_g4_hamming(spark):
    rows = [("r", 1, 1, "", "AA"), ("r", 2, 2, "A2T", "AT"), ("r", 3, 3, "A1T, A2T", "TT")]
    g = spark.createDataFrame(rows, "reference_name string, id int, count long, subs string, s string").withColumn("points", diversity.parse_genotype(F.col("subs")))
    totals = lambda c: [r.total for r in distances.hamming_distribution(g, compat=c).orderBy("x").collect()]
    assert totals(True) == [4, 5, 3] and totals(False) == [4, 8, 3]


def test_g16_sparse_hamming_is_dense_hamming(spark):
    rnd = random.Random(1)
    seqs = list({"".join(rnd.choice("ATGC-") for _ in range(9)) for _ in range(60)})
    rows = [("r", i, rnd.randint(1, 5), [(p, c) for p, c in enumerate(s) if c != "A"]) for i, s in enumerate(seqs)]
    g = spark.createDataFrame(rows, "reference_name string, id int, count long, points array<struct<pos:int,mut:string>>")
    for compat in (False, True):
        want = Counter({0: sum(c * (c - 1) // 2 for _, _, c, _ in rows)})
        for i in range(len(rows)):
            for j in range(i):
                want[sum(a != b for a, b in zip(seqs[i], seqs[j], strict=True))] += rows[i][2] * (1 if compat else rows[j][2])
        got = {r.x: r.total for r in distances.hamming_distribution(g, compat=compat).collect() if r.total}
        assert got == {k: v for k, v in want.items() if v}


def series(spark, ys, rs=None):
    rows = [("g", 1, "s", "e", float(t), c) for t, c in enumerate(ys)]
    rows += [("g", 1, "s", "rest", float(t), (rs or [100] * len(ys))[t] - c) for t, c in enumerate(ys)]
    return spark.createDataFrame(rows, "group string, replicate int, sample_label string, entity string, timepoint double, c long")


@pytest.mark.parametrize(("counts", "nulls"), [([5, 0, 3, 0, 2], "00011"), ([0, 4, 0, 5, 1], "00111"), ([1, 2, 3, 4, 5], "00000")])
def test_g5_dropout(spark, counts, nulls):
    rows = enrich.normalise(series(spark, counts)).filter("entity = 'e'").orderBy("timepoint").collect()
    assert "".join(str(int(r.normalized is None)) for r in rows) == nulls


def test_g6_two_points(spark):
    r = enrich.regress(enrich.normalise(series(spark, [10, 40]))).filter("entity = 'e'").first()
    assert math.isclose(r.enrichment_score, 1.349926717, rel_tol=1e-8) and math.isclose(r.standard_error, 0.373938432, rel_tol=1e-8)


def test_g7_weighted_slope(spark):
    rows = [("g", 1, "s", "e", x, y, w, 1, 1.0) for x, y, w in ((0.0, 0.1, 1.0), (0.3, 0.5, 2.0), (0.6, 0.4, 3.0), (1.0, 1.2, 0.5))]
    d = spark.createDataFrame(rows, "group string, replicate int, sample_label string, entity string, timepoint double, normalized double, weight double, c long, r double")
    r = enrich.regress(d).first()
    assert math.isclose(r.enrichment_score, 0.699669967, rel_tol=1e-8) and math.isclose(r.standard_error, 0.448999561, rel_tol=1e-8)


@pytest.mark.parametrize(("read", "nt", "non", "syn"), [("ATGCAATAA", "A4C", "K2Q", ""), ("ATGAAGTAA", "A6G", "", "K2")])
def test_g8_amino_acids(spark, read, nt, non, syn):
    refs = spark.createDataFrame([("r", "ATGAAATAA", "ATGAAATAA", "ATGAAATAA")], "reference_name string, alignment_seq string, nt_seq string, coding_seq string")
    reads = spark.createDataFrame([("a", "r", 0, 0, "9M", read, None, None)], "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string")
    r = variants.call(variants.trim(reads, refs)).first()
    assert (r.NT_substitutions, r.AA_substitutions_nonsynonymous, r.AA_substitutions_synonymous) == (nt, non, syn)


def test_frameshifts_failures_and_flipped_references(spark):
    nt = "ATGAAACCCGGGTAA"
    back = nt[::-1].translate(str.maketrans("ACGT", "TGCA"))
    refs = spark.createDataFrame([("f", f"GG{nt}CC", nt, nt), ("b", f"GG{back}CC", nt, nt)], "reference_name string, alignment_seq string, nt_seq string, coding_seq string")
    mut = f"GG{back[:4]}{'A' if back[4] != 'A' else 'C'}{back[5:]}CC"
    rows = [
        ("late", "f", 5, "14M", f"GG{nt}CC"[5:]), ("early", "f", 0, "10M", f"GG{nt}CC"[:10]), ("shift", "f", 0, "8M1D10M", f"GG{nt}CC"[:8] + f"GG{nt}CC"[9:]),
        ("flip", "b", 0, "19M", mut), ("unmapped", "f", 0, "19M", f"GG{nt}CC"),
    ]
    d = spark.createDataFrame([(i, r, s, 4 if i == "unmapped" else 0, c, q, None, None) for i, r, s, c, q in rows], "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string")
    t = {r.read_id: r for r in variants.trim(d, refs, allow_frameshift=False).collect()}
    assert set(t) == {"late", "early", "shift", "flip"}
    assert (t["late"].failure_reason, t["early"].failure_reason, t["shift"].failure_reason) == (variants.LATE, variants.EARLY, "frameshift deletion")
    assert t["shift"].failure_index == 6
    called = variants.call(variants.trim(d, refs)).filter("read_id = 'flip'").first()
    pos = len(nt) - 1 - 4
    want = {"A": "T", "C": "G", "G": "C", "T": "A"}[mut[6]]
    assert called.NT_substitutions == f"{nt[pos]}{pos + 1}{want}"
    assert variants.reference_errors(refs).count() == 0
    bad = refs.withColumn("coding_seq", F.lit("ATGX"))
    assert variants.reference_errors(bad).count() == 6


def test_g9_bins_g14_natural_g17_revcomp_g19_context(spark):
    d = spark.createDataFrame([(c,) for c in (1, 1, 5, 10, 11, 100)], "count long")
    assert [r.total for r in diversity.abundance_bins(d).orderBy("x").collect()] == [2, 15, 111]
    names = spark.createDataFrame([("bc10",), ("bc2",), ("bc1",)], "n string")
    assert [r.n for r in names.orderBy(S.natural_key(F.col("n"))).collect()] == ["bc1", "bc2", "bc10"]
    assert one(spark, S.reverse_complement(F.col("s")), s="ACGTN") == "NACGT"
    at = one(spark, S.find_context(F.col("s"), "GCNNNTA"), s="AAGCNNNTACC")
    assert (at.start, at.stop, at.reason) == (4, 7, None)
    assert one(spark, S.find_context(F.col("s"), "GCNNNTA"), s="AAGTNNNTACC").reason == "context_not_present"


def test_g10_timepoints_g11_replicates_g12_fill(spark):
    wide = spark.createDataFrame([(0, "A", "a_1"), (1, "B", "b_1"), (2, "A", "a_2")], "row int, sample_label string, `5` string")
    assert {(r.sample_label, r.tag_group) for r in enrich.timepoints(wide, ["5"]).collect()} == {("A-rep1", "a_1"), ("B", "b_1"), ("A-rep2", "a_2")}
    s = spark.createDataFrame([("g", 1, "s1", "e", 1.0, 0.1), ("g", 2, "s2", "e", 3.0, 0.1)], "group string, replicate int, sample_label string, entity string, enrichment_score double, standard_error double")
    assert math.isclose(enrich.mean_scores(s).first().std_enrichment_score, math.sqrt(2)) and math.isclose(enrich.mean_scores(s, compat=True).first().std_enrichment_score, 1.0)
    f = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 3, 7), (2, 4, None)], "g int, o int, v int")
    assert [r.v for r in common.fill_both_ways(f, ["g"], "o", "v").orderBy("o").collect()] == [None, None, 7, 7]


def test_g15_strand_balance(spark):
    rnd, rows, want = random.Random(2), [], {}
    for g in range(60):
        reads = [(f"r{g}-{k}", rnd.choice("+-"), float(k * 37 % 101)) for k in range(rnd.randint(1, 14))]
        rows += [(r, "x", g, s, q) for r, s, q in reads]
        left = sorted(reads, key=lambda r: r[2])
        while len(left) > 6:
            plus, minus = (sum(r[1] == s for r in left) for s in "+-")
            over = "+" if plus >= minus else "-"
            left.remove(next(r for r in left if r[1] == over))
        want[g] = {r[0] for r in left} if len(reads) >= 2 else set()
    d = spark.createDataFrame(rows, "read_id string, reference_name string, unique_id long, strand string, quality double")
    got = defaultdict(set)
    for r in umi.downsample(d, 2, 6).collect():
        got[r.unique_id].add(r.read_id)
    assert {g: got[g] for g in want} == want


def test_g18_rank(spark):
    rows = [("", 2), ("A1G", 5), ("A1T", 5)]
    cols = ["NT_insertions", "NT_deletions"]
    d = spark.createDataFrame([(f"{s}{k}", "r", s, int(bool(s)), 0, 0, 1.0) for s, n in rows for k in range(n)], "read_id string, reference_name string, NT_substitutions string, NT_substitutions_count long, NT_insertion_length long, NT_deletion_length long, avg_quality double")
    for c in cols:
        d = d.withColumn(c, F.lit(""))
    got = {r.NT_substitutions: r.genotype_ID for r in variants.genotypes(d, aa=False).collect()}
    assert got == {"": "wildtype", "A1G": "1", "A1T": "2"}
    no_wild = variants.genotypes(d.filter("NT_substitutions != ''"), aa=False).collect()
    assert sorted(r.genotype_ID for r in no_wild) == ["1", "2"]


def test_longest_orf_is_the_plain_search(spark):
    rnd, pattern = random.Random(3), re.compile(r"ATG(?:(?!TAA|TAG|TGA)...)*(?:TAA|TAG|TGA)")
    rows = ["CATGAAATAA", "", "ATGTAA", "TTACAT"] + ["".join(rnd.choice("ACGT") for _ in range(rnd.randint(10, 200))) for _ in range(100)]

    def plain(s):
        back = s[::-1].translate(str.maketrans("ATGC", "TACG"))
        return max((m for t in (s, back) for k in range(3) for m in pattern.findall(t[k:])), key=len, default="")

    got = spark.createDataFrame([(s,) for s in rows], "s string").select("s", S.longest_orf(F.col("s")).alias("o")).collect()
    assert all(r.o == plain(r.s) for r in got)


def test_calls_and_genotypes_are_inverse(spark):
    rnd, ref = random.Random(4), "ATGCATGCATGCATG"
    seqs = ["".join(rnd.choice(("ATGC-", c * 5)[rnd.random() < 0.7]) for c in ref) for _ in range(80)]
    d = spark.createDataFrame([(i, ref, s) for i, s in enumerate(seqs)], "id int, ref string, seq string")
    called = diversity.call_mutations(d)
    back = called.withColumn("s", diversity.apply_genotype(F.lit(ref), diversity.parse_genotype(F.col("substitutions"), F.col("deletions"))))
    assert {r.id: r.s for r in back.collect()} == dict(enumerate(seqs))


def test_clusters_match_a_plain_walk(spark):
    rnd = random.Random(6)
    umis = {}
    for _ in range(25):
        base = [rnd.choice("ACGT") for _ in range(8)]
        for _ in range(6):
            u = list(base)
            for _ in range(rnd.randint(0, 2)):
                u[rnd.randrange(8)] = rnd.choice("ACGT")
            umis["".join(u)] = rnd.choice([1, 1, 2, 3, 9, 20])
    dist = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    up = {}
    for u, n in umis.items():
        near = [(-m, v) for v, m in umis.items() if v != u and dist(u, v) <= 1 and m >= 2 * n - 1 and (m > n or (m == n and v < u))]
        up[u] = min(near)[1] if near else u
    root = lambda u: u if up[u] == u else root(up[u])
    got = umi.cluster(spark.createDataFrame([("r", u, n) for u, n in umis.items()], "reference_name string, umi string, umi_count long"))
    assert {r.umi: r.final_umi for r in got.collect()} == {u: root(u) for u in umis}
    totals = Counter()
    for u, n in umis.items():
        totals[root(u)] += n
    assert all(r.final_umi_count == totals[r.final_umi] for r in got.collect())


def test_student_p():
    assert math.isclose(rates.student_p(0.5, 10), 0.141111, rel_tol=1e-4)
    assert math.isclose(rates.student_p(0.9, 5), 0.0373861, rel_tol=1e-4)
    assert rates.student_p(1.0, 9) == 0 and rates.student_p(0.3, 2) == 1 and rates.student_p(None, 5) is None


def test_nearest_matches_all_pairs(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ACGT") for _ in range(7))
    words = list(dict.fromkeys(word() for _ in range(60)))
    queries = list({word() for _ in range(300)})
    for most in (0, 1, 2, 3):
        w = spark.createDataFrame([("t", k, f"b{k}", s) for k, s in enumerate(words)], "barcode_type string, ord int, name string, seq string")
        q = spark.createDataFrame([("t", s) for s in queries], "barcode_type string, seq string")
        want = {}
        for s in queries:
            d, k = min((sum(a != b for a, b in zip(s, x, strict=True)), k) for k, x in enumerate(words))
            if d <= most:
                want[s] = (f"b{k}", d)
        assert {r.seq: (r.name, r.distance) for r in demux.nearest(q, w, most).collect()} == want


def test_readers_and_writers(spark, tmp_path):
    fq = "@r1 k=1\nACGT\n+\nIIII\n@r2\nGG\n+\n@@\n@r3 x\nA\n+\n!\n"
    (tmp_path / "a.fastq").write_text(fq)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(fq)
    for name in ("a.fastq", "b.fastq.gz"):
        got = {r.read_id: (r.description, r.seq, r.quals) for r in readers.read_fastq(spark, str(tmp_path / name)).collect()}
        assert got["r1"] == ("k=1", "ACGT", [40] * 4) and got["r3"] == ("x", "A", [0]) and len(got) >= 2
    (tmp_path / "m.fa").write_text(">a__f:1__g:x\nAC.T\n>b desc\nAC\nGT\n>c\nAQGT\n")
    assert {r.id: r.seq for r in readers.read_fasta(spark, str(tmp_path / "m.fa")).collect()}["b"] == "ACGT"
    msa = {r.id: (r.features, r.seq) for r in readers.read_msa(spark, str(tmp_path / "m.fa"), S.NT_ALPHABET).collect()}
    assert msa == {"a": ({"f": "1", "g": "x"}, "AC-T"), "b": ({}, "AC-T")} or msa["a"][1] == "AC-T" and set(msa) == {"a", "b"}
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nr\t0\tref\t3\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tBC:Z:f1\n")
    r = readers.read_sam(spark, str(tmp_path / "x.sam"), "t").first()
    assert (r.ref_start, r.quals, r.bc, r.nm, r.tag) == (2, [40] * 4, "f1", 1, "t")
    (tmp_path / "t.csv").write_text("﻿tag,runname,n\na,\"x, y\",1\nb,z,\n")
    rows = readers.read_csv(spark, str(tmp_path / "t.csv"), required=("tag",), defaults={"n": 7, "m": 0}, lists=("runname",)).collect()
    assert [(r.tag, r.runname, r.n, r.m) for r in rows] == [("a", ["x", "y"], "1", "0"), ("b", ["z"], "7", "0")]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "t.csv"), required=("nope",))
    (tmp_path / "r.csv").write_text("ref_seq_name,ref_seq_alignment,use_longest_ORF\nq,ccatgaaataa,TRUE\n")
    ref = readers.read_references(spark, str(tmp_path / "r.csv")).first()
    assert (ref.nt_seq, ref.coding_seq) == ("CCATGAAATAA", "ATGAAATAA")
    (tmp_path / "g.csv").write_text("barcode_group,fwd,rvs\ng1,a,\ng2,b,c\n")
    assert [(r.group, r.members) for r in readers.read_groups(spark, str(tmp_path / "g.csv"), ["fwd", "rvs"]).collect()] == [("g1", {"fwd": "a"}), ("g2", {"fwd": "b", "rvs": "c"})]
    assert readers.find_fastqs(str(tmp_path), ["a.fastq"]) == [str(tmp_path / "a.fastq")]
    with pytest.raises(FileNotFoundError):
        readers.find_fastqs(str(tmp_path), ["none.fastq"])
    d = spark.createDataFrame([("s", "ACGT", 2)], "id string, seq string, count int")
    writers.write_fasta(d, str(tmp_path / "out"), count="count", gzip=True)
    assert readers.read_fasta(spark, str(tmp_path / "out")).count() == 2
    writers.write_csv(d, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().seq == "ACGT"


def test_paired_reads_merge(spark):
    whole = "ACGTTGCAAGCTTGACCATGGA"
    turn = str.maketrans("ACGT", "TGCA")
    a = spark.createDataFrame([("r", whole[:16], [30] * 16)], "read_id string, seq string, quals array<int>")
    b = spark.createDataFrame([("r", whole[4:].translate(turn)[::-1], [20] * 18)], "read_id string, seq string, quals array<int>")
    r = umi.merge_pairs(a, b).first()
    assert (r.seq, r.overlap, len(r.quals)) == (whole, 12, len(whole))


def test_stream_gives_the_batch_names(spark, sf, tmp_path):
    reads = synthetic.tagged(spark, sf)
    reads.write.parquet(str(tmp_path / "reads"))
    words = {t: [(f"{t[0]}{k + 1}", s) for k, s in enumerate(seqs)] for t, seqs in synthetic._WORDS.items()}
    stream = spark.readStream.schema(reads.schema).parquet(str(tmp_path / "reads"))
    live.run_to_table(live.running_counts(live.identify(stream, synthetic.BARCODES, words), ["fwd", "rvs"]), "seen")
    batch = registry.queries()["barcode_identify"](spark, sf).groupBy("fwd", "rvs").count()
    assert {(r.fwd, r.rvs): r.n for r in spark.table("seen").collect()} == {(r.fwd, r.rvs): r["count"] for r in batch.collect()}


def test_configuration(spark):
    assert [config.coerce(x) for x in ("True", "all", "3", "2.5", "x", None)] == [True, "all", 3, 2.5, "x", None]
    assert config.as_bool("TRUE") and not config.as_bool("false")
    assert config.barcode_errors({"a": {"context": "ACNNT", "fasta": "f"}, "b": {"context": "ACT", "fasta": "f"}, "c": {"context": ""}}) != []
    assert config.timepoint_errors(["1", "x"], ["t_g", "tg", None]) == ["time x is no number", "tg is not tag_group"]
    refs = synthetic.references(spark)
    assert config.context_errors(refs, ["GGATCC"]).count() == 1 and config.pattern_errors(refs, ["NNNN"]).count() == 0
    assert config.group_errors(synthetic.groups(spark), synthetic.words(spark)).count() == 1
    runs = [config.Run("a", ["x"], "r"), config.Run("b", ["x"], "r"), config.Run("c_d", ["y"])]
    assert sorted(map(len, config.shared_steps(runs).values())) == [1, 2] and len(runs[2].errors()) == 2


def test_weighted_sample_prefers_weight(spark):
    d = spark.range(2000).withColumn("w", F.when(F.col("id") < 100, 1000).otherwise(1))
    got = [r.id for r in sampling.weighted_sample(d, 100, "w").collect()]
    assert len(set(got)) == 100 and np.mean([i < 100 for i in got]) > 0.7


def test_weighted_sample_does_not_depend_on_partitions(spark):
    d = spark.range(500).withColumn("w", F.col("id") % 7)
    runs = [sorted(r.id for r in sampling.weighted_sample(x, 40, "w", seed).collect()) for x, seed in ((d, 1), (d.repartition(7), 1), (d.orderBy(F.desc("id")), 1), (d, 2))]
    assert runs[0] == runs[1] == runs[2] != runs[3]


def test_every_tag_has_its_rows_of_zeros(spark):
    types = [demux.Barcode("fwd", "CCGNNNNNGCA")]
    columns = [F.col("id").cast("string").alias("tag"), F.lit("g1").alias("output_file_barcodes"), F.lit(True).alias("named_by_group"), F.lit("r").alias("reference_name"), F.lit("f1").alias("fwd"), F.lit("none").alias("label_barcodes")]
    counters = [F.lit(0).alias(f"fwd{c}") for c in (":not_exact_match", *(f"_failed:{f}" for f in demux.FAILS))]
    groups = spark.createDataFrame([(0, "g1", {"fwd": "f1"}), (1, "g2", {"fwd": "f2"})], "group_order int, group string, members map<string,string>")
    got = demux.statistics(spark.range(10_050).select(*columns, *counters), types, groups)
    assert got.filter("demuxed_count = 0 and output_file_barcodes = 'g2'").select("tag").distinct().count() == 10_050


def test_background_of_several_rows_is_an_error(spark):
    from strandframe.operators.stats import CHANGES

    rows = spark.range(2).select(F.lit(10).alias("total_seqs"), F.lit(30).alias("total_NT_mutations"), F.col("id").alias("sample"), *(F.lit(2).alias(c) for c in CHANGES))
    assert rates.spectrum(rows, "ACGT", rows.filter("sample = 0").drop("sample")).count() == 24
    with pytest.raises(Exception, match="several rows"):
        rates.spectrum(rows, "ACGT", rows.drop("sample")).collect()


def test_hamming_with_a_position_that_most_have_changed(spark):
    rnd = random.Random(12)
    seqs = list({"C" + "".join(rnd.choice("AAAAAAAG") for _ in range(30)) if k % 10 else "A" + "".join(rnd.choice("AAAT") for _ in range(30)) for k in range(400)})
    rows = [("r", i, 1 + i % 3, [(p, c) for p, c in enumerate(s) if c != "A"]) for i, s in enumerate(seqs)]
    g = spark.createDataFrame(rows, "reference_name string, id int, count long, points array<struct<pos:int,mut:string>>")
    want = Counter({0: sum(c * (c - 1) // 2 for _, _, c, _ in rows)})
    for i in range(len(rows)):
        for j in range(i):
            want[sum(a != b for a, b in zip(seqs[i], seqs[j], strict=True))] += rows[i][2] * rows[j][2]
    assert {r.x: r.total for r in distances.hamming_distribution(g).collect() if r.total} == {k: v for k, v in want.items() if v}
    # Blocks of any size give the same, and so do planes worked off column by column.
    assert {r.x: r.total for r in distances.hamming_distribution(g, block=23).collect() if r.total} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("mismatches", [1, 2, 3])
def test_many_umis_of_one_reference_are_clustered_by_true_neighbours(spark, mismatches):
    rnd = random.Random(mismatches)
    umis = {"".join(rnd.choice("ACGT") for _ in range(10)): rnd.choice([1, 2, 5, 40]) for _ in range(700)}
    dist = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    up = {}
    for u, n in umis.items():
        near = [(-m, v) for v, m in umis.items() if v != u and m >= 2 * n - 1 and (m > n or (m == n and v < u)) and dist(u, v) <= mismatches]
        up[u] = min(near)[1] if near else u
    root = lambda u: u if up[u] == u else root(up[u])
    got = umi.cluster(spark.createDataFrame([("r", u, n) for u, n in umis.items()], "reference_name string, umi string, umi_count long"), mismatches)
    assert {r.umi: r.final_umi for r in got.collect()} == {u: root(u) for u in umis}


def test_a_hundred_thousand_umis_of_one_reference(spark):
    codes = F.translate(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 10), "0123456789abcdef", "ACGTACGTACGTACGT")
    u = spark.range(100_000).select(F.lit("r").alias("reference_name"), codes.alias("umi")).groupBy("reference_name", "umi").agg(F.count("*").alias("umi_count"))
    met = umi._masked(u, 1).groupBy("reference_name", "n", "key").count().agg(F.max("count")).first()[0]
    assert met <= 4 and umi.cluster(u).agg(F.sum("umi_count")).first()[0] == 100_000


def test_components_are_those_of_the_plain_matrix(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [(int(p), str(rnd.choice(list("ACG")))) for p in rnd.choice(12, rnd.integers(0, 6), replace=False)]) for i in range(80)]
    g = spark.createDataFrame(rows, "id int, points array<struct<pos:int,mut:string>>")
    got = np.array([(r.PCA1, r.PCA2) for r in diversity.embed(g).orderBy("id").collect()])
    columns = sorted({p for _, points in rows for p in points})
    x = np.array([[float(c in points) for c in columns] for _, points in rows])
    axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][:2]
    assert np.allclose(np.abs(got), np.abs(x @ axes.T), atol=1e-6)
    with pytest.raises(ValueError):
        diversity.embed(g, sites=3)


def test_best_hits_on_both_strands(spark):
    from strandframe.operators import explore

    rnd = random.Random(4)
    refs = {n: "".join(rnd.choice("ACGT") for _ in range(120)) for n in ("a", "b", "c")}
    turn = str.maketrans("ACGT", "TGCA")
    reads = []
    for k in range(60):
        name = rnd.choice(list(refs))
        lo = rnd.randrange(40)
        seq = list(refs[name][lo : lo + 70])
        seq[rnd.randrange(70)] = rnd.choice("ACGT")
        del seq[rnd.randrange(70)]
        text = "".join(seq)
        reads.append((f"{name}{'-+'[k % 2]}{k}", text if k % 2 else text.translate(turn)[::-1]))
    got = explore.best_hits(spark.createDataFrame([*reads, ("none", "ACGTA"), ("null", None)], "read_id string, seq string"), spark.createDataFrame(refs.items(), "reference_name string, alignment_seq string"))
    rows = got.collect()
    odd = {r.read_id: (r.reference_name is None, r.score > 0) for r in rows if r.read_id in ("none", "null")}
    assert odd == {"none": (False, True), "null": (True, False)}
    rows = [r for r in rows if r.read_id not in odd]
    assert len(rows) == 60 and all((r.reference_name, r.strand) == (r.read_id[0], r.read_id[1]) for r in rows)
    assert all(r.score == max(explore.align(ref, s, 2, -4, -4, -2, True)[0] for ref in refs.values() for s in (dict(reads)[r.read_id], dict(reads)[r.read_id].translate(turn)[::-1])) for r in rows[:8])


def test_pairwise_alignment(spark):
    from strandframe.operators import explore

    rnd = random.Random(9)

    def plain(a, b):
        """Best global score by trying every split into pair, gap and gap (memoised)."""
        from functools import cache

        @cache
        def go(i, j, state):
            if i == len(a) and j == len(b):
                return 0
            out = -(10**9)
            if i < len(a) and j < len(b):
                out = max(out, (2 if a[i] == b[j] else -4) + go(i + 1, j + 1, 0))
            if i < len(a):
                out = max(out, (-2 if state == 1 else -6) + go(i + 1, j, 1))
            if j < len(b):
                out = max(out, (-2 if state == 2 else -6) + go(i, j + 1, 2))
            return out

        return go(0, 0, 0)

    rows = [("".join(rnd.choice("ACG") for _ in range(rnd.randint(1, 7))), "".join(rnd.choice("ACG") for _ in range(rnd.randint(1, 7)))) for _ in range(40)]
    got = explore.align_pairs(spark.createDataFrame(rows, "ref string, seq string")).collect()
    for r in got:
        assert r.score == plain(r.ref, r.seq)
        assert r.aligned_ref.replace("-", "") == r.ref and r.aligned_seq.replace("-", "") == r.seq and len(r.aligned_ref) == len(r.aligned_seq)
    local = explore.align("TTTACGTACGTTT", "GGACGTACGGG", 2, -4, -4, -2, True)
    assert local[1:] == ("ACGTACG", "ACGTACG") and local[0] == 14


def test_structure_uses_the_best_chain(spark):
    from strandframe.operators import explore

    pos = spark.createDataFrame([("A", p, p + 10, p != 1, 3) for p in range(1, 4)] + [("B", p, p + 20, True, 3) for p in range(1, 4)], "chain string, position long, residue int, wt_match boolean, coverage int")
    prof = spark.createDataFrame([(2, 0.5)], "position long, frequency double")
    assert sorted((r.chain, r.residue, r.frequency) for r in explore.on_structure(prof, pos).collect()) == [("B", 21, 0.0), ("B", 22, 0.5), ("B", 23, 0.0)]


def test_structure_files(spark, tmp_path):
    cif = ["ATOM 1 N N . MET A 1 1 ? 1.0 2.0 3.0 1.00 9.0 ? 7 MET A N 1", "ATOM 2 C CA . MET A 1 1 ? 1.0 2.0 3.0 1.00 9.0 ? 7 MET A CA 1", "ATOM 3 C CA . ZZZ A 1 2 ? 1.0 2.0 3.0 1.00 9.0 ? 8 ZZZ A CA 1", "HETATM 4 O O . HOH B 2 . ? 1 1 1 1 1 ? 1 HOH A O 1"]
    (tmp_path / "x.cif").write_text("data_x\nloop_\n" + "\n".join(cif) + "\n")
    got = readers.read_structure(spark, str(tmp_path / "x.cif")).orderBy("residue").collect()
    assert [tuple(r) for r in got] == [("A", 7, "", "M"), ("A", 8, "", "X")]


def test_throughput_with_seconds(spark):
    watch = stats.Stopwatch(spark)
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches

    first = watch.step("a", spark.range(5).coalesce(1).mapInArrow(count, "id long"))
    watch.step("b", first.filter("id < 2"))
    got = watch.table().collect()
    assert [(r.pipeline_step, r.sequences) for r in got] == [("a", 5), ("b", 2)] and all(r.seconds > 0 for r in got)
    assert runs.value == 1 and watch.step("c", first.limit(0)).count() == 0
