"""Queries on alignments, mutation calls and sequence functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.scratch import Scratch
from strandframe.operators import stats, variants
from strandframe.operators.common import distribution, ranked
from strandframe.plans import synthetic as T

MIN_Q = 14

_REFS = ", ".join(f"('{n}', '{a}', '{nt}', {T.CDS[n][0]}, {T.CDS[n][1]}, {'TRUE' if n == 'refB' else 'FALSE'})" for n, a, nt, _ in T.REFERENCES)
_CODONS = ", ".join(f"('{c}', '{a}')" for c, a in S.CODONS.items())
#: Base by base: every aligned reference position of every read, then calls, codons and genotype columns.
CALLS = f"""
WITH refs(reference_name, aln, nt, lo, hi, flip) AS (VALUES {_REFS}),
codes(codon, aa) AS (VALUES {_CODONS}),
reads AS ({T.READS}),
parts AS (SELECT read_id, unnest(l) AS o, generate_subscripts(l, 1) AS k FROM (SELECT read_id, regexp_extract_all(cigar, '[0-9]+[MIDS]') AS l FROM reads)),
ops AS (SELECT read_id, k, right(o, 1) AS op, CAST(left(o, length(o) - 1) AS INT) AS n FROM parts),
offs AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D') THEN n ELSE 0 END) OVER w, 0)::INT AS r0,
                coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN n ELSE 0 END) OVER w, 0)::INT AS q0,
                coalesce(sum(CASE WHEN op = 'S' AND k = 1 THEN n ELSE 0 END) OVER (PARTITION BY read_id), 0)::INT AS clip
         FROM ops WINDOW w AS (PARTITION BY read_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
spans AS (SELECT read_id, reference_name, ref_start, ref_start + sum(CASE WHEN op IN ('M', 'D') THEN n ELSE 0 END)::INT AS ref_end
          FROM offs JOIN reads USING (read_id) GROUP BY read_id, reference_name, ref_start),
state AS (SELECT *, CASE WHEN ref_start > {T.START} THEN '{variants.LATE}' WHEN ref_end < {T.END} THEN '{variants.EARLY}' END AS failure_reason FROM spans),
laid AS (SELECT read_id, reference_name, tag, op, ref_start + r0 + j.j AS rpos, q0 - clip + j.j + 1 AS i,
                CASE WHEN op = 'D' THEN '-' ELSE substr(query_seq, (q0 + j.j + 1)::INT, 1) END AS base
         FROM offs JOIN reads USING (read_id), range(0, n) j(j) WHERE op IN ('M', 'D')),
region AS (SELECT read_id, l.reference_name, tag, CASE WHEN flip THEN {T.END} - 1 - rpos ELSE rpos - {T.START} END::INT AS pos,
                  CASE WHEN flip THEN translate(base, 'ACGT', 'TGCA') ELSE base END AS base,
                  CASE WHEN op = 'D' THEN 0 ELSE {T.QUALITY} END AS q, nt, lo, hi
           FROM laid l JOIN refs USING (reference_name) WHERE rpos >= {T.START} AND rpos < {T.END}),
full_ AS (SELECT *, substr(nt, pos + 1, 1) AS wt FROM region),
indels AS (SELECT read_id, op, n, lo, hi,
                  CASE WHEN NOT flip THEN ref_start + r0 - {T.START} WHEN op = 'I' THEN {T.END} - ref_start - r0 ELSE {T.END} - ref_start - r0 - n END AS pos,
                  CASE WHEN op = 'I' THEN CASE WHEN flip THEN reverse(translate(substr(query_seq, q0 + 1, n), 'ACGT', 'TGCA')) ELSE substr(query_seq, q0 + 1, n) END END AS ins
           FROM offs JOIN reads USING (read_id) JOIN refs USING (reference_name)
           WHERE op = 'I' AND ref_start + r0 >= {T.START} AND ref_start + r0 < {T.END}
              OR op = 'D' AND ref_start + r0 + n >= {T.START} AND ref_start + r0 < {T.END}),
subs AS (SELECT f.*, wt || (pos + 1) || base AS name FROM full_ f JOIN state USING (read_id)
         WHERE failure_reason IS NULL AND base <> wt AND base <> '-' AND q >= {MIN_Q}),
touched AS (SELECT read_id, floor((pos - lo) / 3)::INT AS codon FROM indels WHERE op = 'I' AND pos >= lo AND pos < hi AND (pos - lo) % 3 <> 0
            UNION SELECT read_id, c.c::INT FROM indels, range(trunc((pos - lo) / 3)::INT, trunc((pos + n - lo) / 3)::INT + 1) c(c)
            WHERE op = 'D' AND (pos >= lo AND pos < hi OR pos + n >= lo AND pos + n < hi)),
hit AS (SELECT DISTINCT read_id, reference_name, lo, floor((pos - lo) / 3)::INT AS codon FROM subs WHERE pos >= lo AND pos < hi),
codons AS (SELECT h.read_id, h.reference_name, h.codon, string_agg(f.wt, '' ORDER BY f.pos) AS w, string_agg(f.base, '' ORDER BY f.pos) AS m
           FROM hit h JOIN full_ f ON f.read_id = h.read_id AND floor((f.pos - h.lo) / 3) = h.codon
           WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.read_id = h.read_id AND t.codon = h.codon)
           GROUP BY ALL HAVING min(f.q) >= {MIN_Q}),
aas AS (SELECT read_id, reference_name, codons.codon AS codon, coalesce(a.aa, 'X') AS w, coalesce(b.aa, 'X') AS m FROM codons LEFT JOIN codes a ON a.codon = codons.w LEFT JOIN codes b ON b.codon = codons.m),
called AS (
  SELECT s.read_id, s.reference_name, r.tag, coalesce(nts, '') AS NT_substitutions, coalesce(nt_n, 0) AS NT_substitutions_count,
         coalesce(ins, '') AS NT_insertions, coalesce(dels, '') AS NT_deletions, coalesce(ins_n, 0)::BIGINT AS NT_insertion_length, coalesce(del_n, 0)::BIGINT AS NT_deletion_length,
         coalesce(non, '') AS AA_substitutions_nonsynonymous, coalesce(syn, '') AS AA_substitutions_synonymous, coalesce(non_n, 0) AS AA_substitutions_nonsynonymous_count
  FROM state s JOIN reads r USING (read_id)
  LEFT JOIN (SELECT read_id, string_agg(name, ', ' ORDER BY pos) AS nts, count(*) AS nt_n FROM subs GROUP BY read_id) USING (read_id)
  LEFT JOIN (SELECT read_id, string_agg(pos || 'ins' || ins, ', ' ORDER BY pos) AS ins, sum(n) AS ins_n FROM indels WHERE op = 'I' GROUP BY read_id) USING (read_id)
  LEFT JOIN (SELECT read_id, string_agg(pos || 'del' || n, ', ' ORDER BY pos) AS dels, sum(n) AS del_n FROM indels WHERE op = 'D' GROUP BY read_id) USING (read_id)
  LEFT JOIN (SELECT read_id, string_agg(w || (codon + 1) || m, ', ' ORDER BY codon) FILTER (WHERE w <> m) AS non, count(*) FILTER (WHERE w <> m) AS non_n,
                    string_agg(w || (codon + 1), ', ' ORDER BY codon) FILTER (WHERE w = m) AS syn FROM aas GROUP BY read_id) USING (read_id)
  WHERE failure_reason IS NULL),
condensed AS (
  SELECT reference_name, NT_substitutions, NT_substitutions_count, NT_insertions, NT_deletions, NT_insertion_length, NT_deletion_length, AA_substitutions_nonsynonymous,
         AA_substitutions_synonymous, AA_substitutions_nonsynonymous_count, count(*) AS "count", NT_substitutions = '' AND NT_insertions = '' AND NT_deletions = '' AS wild
  FROM called GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY reference_name ORDER BY wild DESC, "count" DESC, NT_substitutions_count, NT_substitutions, NT_insertions, NT_deletions)
                  - max(wild::INT) OVER (PARTITION BY reference_name) AS genotype_rank FROM condensed),
dist AS (SELECT reference_name, x, coalesce(total, 0) AS total FROM
           (SELECT reference_name, unnest(range(0, top + 1)) AS x FROM (SELECT reference_name, max(NT_substitutions_count) AS top FROM called GROUP BY 1)) t
           LEFT JOIN (SELECT reference_name, NT_substitutions_count AS x, count(*) AS total FROM called GROUP BY ALL) c USING (reference_name, x)),
grid AS (SELECT reference_name, nt, seqs, unnest(range(1, length(nt) + 1)) AS p FROM refs JOIN (SELECT reference_name, count(*) AS seqs FROM called GROUP BY 1) USING (reference_name)),
tidy AS (SELECT g.reference_name, substr(nt, g.p::INT, 1) AS wt, g.p AS position, g.m AS mutation, coalesce(c, 0) AS n, seqs
         FROM (SELECT * FROM grid CROSS JOIN (VALUES ('A'), ('T'), ('G'), ('C')) m(m)) g
         LEFT JOIN (SELECT reference_name, pos + 1 AS p, base AS m, count(*) AS c FROM subs GROUP BY reference_name, pos, base) s ON s.reference_name = g.reference_name AND s.p = g.p AND s.m = g.m)
"""


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.trim(T.reads(spark, sf_dir), T.references(spark))


def _called(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.call(_trimmed(spark, sf_dir), MIN_Q)


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls of every usable read, without sequences, written once for queries that read them twice."""
    return Scratch(spark, "calls").save(_called(spark, sf_dir).select("read_id", "reference_name", "avg_quality", *variants.MUTATION_COLUMNS, *variants.AA_COLUMNS))


def cigar_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable read along its reference: region, match line, qualities and indels."""
    t = _trimmed(spark, sf_dir).filter("failure_reason is null")
    return t.select(
        "read_id", "query", S.match_line(F.col("ref"), F.col("query")).alias("match_line"), F.aggregate("quals", F.lit(0), lambda a, x: a + x).cast("long").alias("quality_sum"),
        F.array_join(F.transform("insertions", lambda x: F.concat(x["pos"].cast("string"), F.lit("ins"), x["seq"])), ", ").alias("insertions"),
        F.array_join(F.transform("deletions", lambda x: F.concat(x["pos"].cast("string"), F.lit("del"), x["len"].cast("string"))), ", ").alias("deletions"),
    )


CIGAR_FOLD = CALLS + """
SELECT f.read_id, string_agg(base, '' ORDER BY pos) AS query, string_agg(CASE WHEN base = '-' THEN ' ' WHEN base = wt THEN '|' ELSE '.' END, '' ORDER BY pos) AS match_line,
       sum(q)::BIGINT AS quality_sum, any_value(coalesce(i.ins, '')) AS insertions, any_value(coalesce(d.dels, '')) AS deletions
FROM full_ f JOIN state s USING (read_id)
LEFT JOIN (SELECT read_id, string_agg(pos || 'ins' || ins, ', ' ORDER BY pos) AS ins FROM indels WHERE op = 'I' GROUP BY read_id) i USING (read_id)
LEFT JOIN (SELECT read_id, string_agg(pos || 'del' || n, ', ' ORDER BY pos) AS dels FROM indels WHERE op = 'D' GROUP BY read_id) d USING (read_id)
WHERE s.failure_reason IS NULL GROUP BY f.read_id
"""


def gapped_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References along the reads: insertions are gaps, deletions are left out."""
    r = T.reads(spark, sf_dir).join(F.broadcast(T.references(spark)), "reference_name")
    segs = S.cigar_segments(S.cigar_ops(F.col("cigar")))
    return r.withColumn("segs", segs).select("read_id", S.gapped_reference(F.col("alignment_seq"), F.col("ref_start"), F.col("segs")).alias("gapped_ref"))


GAPPED = CALLS + """
SELECT read_id, string_agg(CASE op WHEN 'M' THEN substr(aln, ref_start + r0 + 1, n) WHEN 'I' THEN repeat('-', n) ELSE '' END, '' ORDER BY k) AS gapped_ref
FROM offs JOIN reads USING (read_id) JOIN refs USING (reference_name) GROUP BY read_id
"""


def mutation_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotype columns of every usable read."""
    return _called(spark, sf_dir).select("read_id", "reference_name", *variants.MUTATION_COLUMNS, *variants.AA_COLUMNS)


CALLED = CALLS + "SELECT * EXCLUDE (tag) FROM called"


def genotype_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes with counts, ranks and names."""
    return variants.genotypes(_called(spark, sf_dir)).drop("best_read")


RANKED = CALLS + "SELECT * EXCLUDE (wild), CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS genotype_ID FROM ranked"


def seq_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genotype of every read."""
    called = _kept(spark, sf_dir)
    return variants.seq_ids(called, variants.genotypes(called))


SEQ_IDS = CALLS + """
SELECT c.read_id AS "seq_ID", c.reference_name, CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS genotype_ID
FROM called c JOIN ranked r USING (reference_name, NT_substitutions, NT_insertions, NT_deletions, AA_substitutions_nonsynonymous, AA_substitutions_synonymous)
"""


def genotype_best_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read of the highest mean quality of every genotype, the last id of equals."""
    return variants.genotypes(_called(spark, sf_dir)).select("reference_name", "genotype_ID", "best_read")


BEST = CALLS + """, means AS (SELECT read_id, sum(q) / count(*) AS avg_q FROM full_ GROUP BY 1)
SELECT reference_name, genotype_ID, best_read FROM (
  SELECT c.reference_name, CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS genotype_ID,
         first_value(c.read_id) OVER (PARTITION BY c.reference_name, genotype_rank ORDER BY avg_q DESC, c.read_id DESC) AS best_read
  FROM called c JOIN means USING (read_id) JOIN ranked r USING (reference_name, NT_substitutions, NT_insertions, NT_deletions, AA_substitutions_nonsynonymous, AA_substitutions_synonymous)) x GROUP BY ALL
"""


def failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that do not span the region."""
    return variants.failures(_trimmed(spark, sf_dir)).drop("failure_index")


FAILED = CALLS + 'SELECT read_id AS "seq_ID", reference_name, failure_reason FROM state WHERE failure_reason IS NOT NULL'


def nt_mutations_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substitution counts of every position and base."""
    out = variants.tidy_counts(_called(spark, sf_dir), T.references(spark))
    return out.withColumn("proportion_of_seqs", F.round("proportion_of_seqs", 9))


TIDY = CALLS + "SELECT reference_name, wt, position, mutation, CASE WHEN wt <> mutation THEN n END AS total_count, round(CASE WHEN wt <> mutation THEN n / seqs END, 9) AS proportion_of_seqs FROM tidy"


def aa_mutations_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amino-acid changes seen, by position."""
    out = variants.tidy_counts(_called(spark, sf_dir), T.references(spark), "AA")
    return out.filter("total_count > 0").select("reference_name", "wt", "position", "mutation", "total_count")


AA_TIDY = CALLS + "SELECT reference_name, w AS wt, (codon + 1)::BIGINT AS position, m AS mutation, count(*) AS total_count FROM aas WHERE w <> m AND m <> 'X' GROUP BY ALL"


def mutation_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of substitutions per read."""
    d = variants.mutation_distribution(_called(spark, sf_dir))
    return d.select("reference_name", "x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


_SHARES = "round(total / sum(total) OVER p, 9) AS proportion, round(sum(total) OVER (p ORDER BY x) / sum(total) OVER p, 9) AS cumulative"
DISTRIBUTION = CALLS + f"SELECT reference_name, x::INT AS x, total::BIGINT AS total, {_SHARES} FROM dist WINDOW p AS (PARTITION BY reference_name)"


def mutation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full statistics row of every reference: the flagship query."""
    refs, by = T.references(spark), ["reference_name"]
    # Seven tables come from one pass over the reads: it is written once, without sequences and qualities.
    states = variants.call(_trimmed(spark, sf_dir), MIN_Q, keep_failed=True)
    states = Scratch(spark, "calls").save(states.select("read_id", "reference_name", "failure_reason", "failure_index", "nt", "aa_changes", "avg_quality", *variants.MUTATION_COLUMNS, *variants.AA_COLUMNS))
    called = states.filter("failure_reason is null")
    out = stats.mutation_stats(
        by, variants.mutation_distribution(called), variants.tidy_counts(called, refs), variants.genotypes(called), variants.failures(states),
        variants.mutation_distribution(called, "AA"), variants.tidy_counts(called, refs, "AA"),
    )
    return out.select(*(F.col(f"`{c}`").cast("long").alias(c) if t == "bigint" else F.col(f"`{c}`") for c, t in out.dtypes))


_CH = ", ".join(f"sum(CASE WHEN wt = '{c[0]}' AND mutation = '{c[-1]}' THEN n ELSE 0 END)::BIGINT AS \"{c}\", sum(CASE WHEN wt = '{c[0]}' AND mutation = '{c[-1]}' AND n > 0 THEN 1 ELSE 0 END)::BIGINT AS \"{c}_unique\"" for c in stats.CHANGES)
_TR = "wt || mutation IN ('AG', 'GA', 'TC', 'CT')"
STATS = CALLS + f"""
, cells AS (SELECT reference_name, count(DISTINCT position) AS reference_length, sum(n)::BIGINT AS "total_NT_mutations", sum((n > 0)::INT)::BIGINT AS "unique_NT_mutations",
    sum(CASE WHEN {_TR} THEN n ELSE 0 END)::BIGINT AS transitions, sum(CASE WHEN {_TR} THEN 0 ELSE n END)::BIGINT AS transversions,
    sum(CASE WHEN {_TR} AND n > 0 THEN 1 ELSE 0 END)::BIGINT AS transitions_unique, sum(CASE WHEN NOT {_TR} AND n > 0 THEN 1 ELSE 0 END)::BIGINT AS transversions_unique, {_CH}
  FROM tidy WHERE wt <> mutation GROUP BY 1),
means AS (SELECT reference_name, count(*) AS total_seqs, avg(NT_substitutions_count) AS nt_mean, trunc(quantile_cont(NT_substitutions_count::DOUBLE, 0.5))::BIGINT AS "median_NT_mutations_per_seq",
    round_even(avg(AA_substitutions_nonsynonymous_count), 2) AS "mean_AA_mutations_per_seq", trunc(quantile_cont(AA_substitutions_nonsynonymous_count::DOUBLE, 0.5))::BIGINT AS "median_AA_mutations_per_seq" FROM called GROUP BY 1),
kinds AS (SELECT reference_name, count(DISTINCT NT_substitutions || '/' || NT_insertions || '/' || NT_deletions) AS unique_genotypes, sum(NT_insertion_length)::BIGINT AS total_insertion_length,
    sum(NT_deletion_length)::BIGINT AS total_deletion_length FROM condensed GROUP BY 1),
lost AS (SELECT reference_name, count(*) AS lost FROM state WHERE failure_reason IS NOT NULL GROUP BY 1),
aa_n AS (SELECT reference_name, sum(c)::BIGINT AS "total_AA_mutations", count(*) AS "unique_AA_mutations" FROM
    (SELECT reference_name, codon, m, count(*) AS c FROM aas WHERE w <> m AND m <> 'X' GROUP BY ALL) GROUP BY 1)
SELECT * EXCLUDE (nt_mean, lost), round_even(nt_mean, 2) AS "mean_NT_mutations_per_seq", round_even(nt_mean / reference_length, 10) AS "mean_NT_mutations_per_base", coalesce(lost, 0) AS total_failed_seqs
FROM means JOIN cells USING (reference_name) JOIN kinds USING (reference_name) LEFT JOIN lost USING (reference_name) LEFT JOIN aa_n USING (reference_name)
"""


def _hexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("h"), F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("g"))
    nt = lambda c: F.translate(c, "0123456789abcdef", "ACGTACGTACGTACGT")
    return d.select("o_orderkey", nt("h").alias("s"), nt("g").alias("t"))


_HEXED = "(SELECT o_orderkey, translate(md5(o_orderkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s, translate(md5(o_custkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS t FROM orders)"


def seq_revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hexed(spark, sf_dir).select("o_orderkey", S.reverse_complement(F.col("s")).alias("revcomp"))


REVCOMP = f"SELECT o_orderkey, reverse(translate(s, 'ACGT', 'TGCA')) AS revcomp FROM {_HEXED}"


def seq_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hexed(spark, sf_dir).select("o_orderkey", S.translate_nt(F.col("s")).alias("protein"))


TRANSLATE = f"""WITH codes(codon, aa) AS (VALUES {_CODONS})
SELECT o_orderkey, string_agg(aa, '' ORDER BY k.k) AS protein FROM {_HEXED} x, range(0, 10) k(k) JOIN codes ON codon = substr(s, (k.k * 3 + 1)::INT, 3) GROUP BY o_orderkey"""


def seq_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hexed(spark, sf_dir).select("o_orderkey", S.hamming(F.col("s"), F.col("t")).cast("long").alias("distance"))


HAMMING = f"SELECT o_orderkey, hamming(s, t)::BIGINT AS distance FROM {_HEXED}"


def longest_orf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest reading frame of every read; SQL has no look-ahead patterns, so tests compare with a plain search."""
    return _hexed(spark, sf_dir).select("o_orderkey", S.longest_orf(F.concat("s", "t")).alias("orf"))


def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier names as bc1..bcN in natural order."""
    d = T.table(spark, sf_dir, "supplier").select(F.concat(F.lit("bc"), F.col("s_suppkey").cast("string")).alias("name"))
    # Letters, then the length of the number and its first digits: names are numbered in the runs that these make.
    number = F.regexp_replace("name", r"^\D*0*", "")
    coarse = [F.regexp_extract("name", r"^\D*", 0), F.length(number), F.substring(number, 1, 3)]
    return ranked(d, [], coarse, [S.natural_key(F.col("name"))], "place").select("name", "place")


NATURAL = "SELECT 'bc' || s_suppkey AS name, row_number() OVER (ORDER BY s_suppkey) AS place FROM supplier"


def dist_to_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense distribution of line quantities per return flag."""
    d = distribution(T.table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"])
    return d.select("l_returnflag", "x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


DIST = f"""SELECT l_returnflag, x::INT AS x, total::BIGINT AS total, {_SHARES} FROM (
  SELECT l_returnflag, x, coalesce(total, 0) AS total FROM (SELECT l_returnflag, unnest(range(0, top + 1)) AS x FROM (SELECT l_returnflag, max(l_quantity)::INT AS top FROM lineitem GROUP BY 1)) t
  LEFT JOIN (SELECT l_returnflag, l_quantity::INT AS x, count(*) AS total FROM lineitem GROUP BY ALL) c USING (l_returnflag, x)) WINDOW p AS (PARTITION BY l_returnflag)"""


def distribution_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and whole median of the substitutions per read."""
    d = variants.mutation_distribution(_called(spark, sf_dir))
    by = ["reference_name"]
    return stats.distribution_mean(d, by).withColumn("mean", F.round("mean", 9)).join(stats.distribution_median(d, by), by)


MOMENTS = CALLS + "SELECT reference_name, round(avg(NT_substitutions_count), 9) AS mean, trunc(quantile_cont(NT_substitutions_count::DOUBLE, 0.5))::BIGINT AS median FROM called GROUP BY 1"


def merged_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One distribution over all references."""
    d = stats.merge_distributions(variants.mutation_distribution(_called(spark, sf_dir)))
    return d.select("x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


MERGED = CALLS + f"SELECT x::INT AS x, total::BIGINT AS total, {_SHARES} FROM (SELECT x, sum(total) AS total FROM dist GROUP BY 1) WINDOW p AS ()"


def top_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned text of the five most abundant genotypes of a reference, and of the wild type."""
    t = _trimmed(spark, sf_dir)
    called = variants.call(t, MIN_Q)
    return variants.genotype_alignments(t, called, variants.genotypes(called), 5).select("reference_name", "genotype_ID", "count", "match", "query")


TOP_GENOTYPES = CALLS + """, means AS (SELECT read_id, sum(q) / count(*) AS avg_q FROM full_ GROUP BY 1),
best AS (SELECT c.reference_name, CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS genotype_ID, "count", c.read_id,
    row_number() OVER (PARTITION BY c.reference_name, genotype_rank ORDER BY avg_q DESC, c.read_id DESC) AS k
  FROM called c JOIN means USING (read_id) JOIN ranked r USING (reference_name, NT_substitutions, NT_insertions, NT_deletions, AA_substitutions_nonsynonymous, AA_substitutions_synonymous) WHERE genotype_rank <= 5)
SELECT b.reference_name, genotype_ID, "count", string_agg(CASE WHEN base = '-' THEN ' ' WHEN base = wt THEN '|' ELSE '.' END, '' ORDER BY pos) AS match, string_agg(base, '' ORDER BY pos) AS query
FROM best b JOIN full_ f USING (read_id) WHERE k = 1 GROUP BY ALL"""


def alignment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and identity of the alignments, with one mismatch noted for every odd order."""
    sam = T.reads(spark, sf_dir).withColumn("nm", (F.col("read_id").cast("long") % 2).cast("int"))
    out = stats.alignment_stats(sam)
    return out.select("ID", "flag", F.col("length").cast("long").alias("length"), F.col("mapped_length").cast("long").alias("mapped_length"), F.round("identity", 9).alias("identity"))


ALIGNED = CALLS + """SELECT read_id AS "ID", 0 AS flag, sum(CASE WHEN op IN ('M', 'I', 'S') THEN n ELSE 0 END)::BIGINT AS length, sum(CASE WHEN op IN ('M', 'I') THEN n ELSE 0 END)::BIGINT AS mapped_length,
round((sum(CASE WHEN op IN ('M', 'I') THEN n ELSE 0 END) - any_value(read_id::BIGINT % 2)) / sum(CASE WHEN op IN ('M', 'I') THEN n ELSE 0 END), 9) AS identity FROM ops GROUP BY 1"""

QUERIES = {
    f.__name__: (f, sql)
    for f, sql in (
        (mutation_stats, STATS), (cigar_fold, CIGAR_FOLD), (gapped_reference, GAPPED), (mutation_calls, CALLED), (genotype_rank, RANKED), (seq_ids, SEQ_IDS),
        (genotype_best_quality, BEST), (failure_log, FAILED), (nt_mutations_tidy, TIDY), (aa_mutations_tidy, AA_TIDY), (mutation_distribution, DISTRIBUTION),
        (distribution_moments, MOMENTS), (merged_distribution, MERGED), (top_genotypes, TOP_GENOTYPES), (alignment_stats, ALIGNED), (seq_revcomp, REVCOMP),
        (seq_translate, TRANSLATE), (seq_hamming, HAMMING), (longest_orf, None), (natural_sort, NATURAL), (dist_to_df, DIST),
    )
}
