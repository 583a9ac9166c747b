"""Queries on enrichment, diversity, rates and general relational steps, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.operators import distances, diversity, enrich, manifold, rates, stats, variants
from strandframe.operators.common import keep_quantile, label_union, runs
from strandframe.operators.sampling import weighted_sample
from strandframe.plans import synthetic as T
from strandframe.plans.queries_sequence import CALLS, MIN_Q, _called, _kept

#: Dense counts, per-sample shares, dropout mask, log ratios and weights.
DENSE = f"""
WITH counts AS ({T.COUNTS}),
samples AS (SELECT DISTINCT sample_label, rep, timepoint FROM counts),
grid AS (SELECT s.sample_label, s.rep, e.entity, s.timepoint FROM samples s JOIN (SELECT DISTINCT sample_label, entity FROM counts) e USING (sample_label)),
dense AS (SELECT 'grp' AS "group", g.rep AS replicate, g.sample_label, g.entity, g.timepoint, coalesce(c, 0)::BIGINT AS c FROM grid g LEFT JOIN counts USING (sample_label, entity, timepoint)),
totals AS (SELECT sample_label, timepoint, sum(c)::DOUBLE AS r FROM dense GROUP BY 1, 2),
shares AS (SELECT *, r / sum(r) OVER (PARTITION BY sample_label) AS share FROM totals),
normed AS (SELECT dense.*, r, CASE WHEN sum((c = 0)::INT) OVER (PARTITION BY sample_label, entity ORDER BY timepoint) < 2 THEN ln((c + 0.5::DOUBLE) / (r + 0.5::DOUBLE)) END AS normalized,
             share / (1 / (c + 0.5::DOUBLE) + 1 / (r + 0.5::DOUBLE)) AS weight FROM dense JOIN shares USING (sample_label, timepoint)),
pts AS (SELECT *, timepoint / max(timepoint) OVER (PARTITION BY sample_label) AS x FROM normed),
sums AS (SELECT "group", replicate, sample_label, entity, count(*) AS n, sum(weight) AS w, sum(weight * x) AS wx, sum(weight * normalized) AS wy,
           max(normalized) AS hi, arg_max(normalized, x) - arg_min(normalized, x) AS rise, sqrt(sum(1 / (r + 0.5::DOUBLE) + 1 / (c + 0.5::DOUBLE))) AS se2 FROM pts WHERE normalized IS NOT NULL GROUP BY ALL),
devs AS (SELECT s.*, sum(weight * (x - wx / w) ** 2) AS sxx, sum(weight * (x - wx / w) * (normalized - wy / w)) AS sxy, sum(weight * (normalized - wy / w) ** 2) AS syy
         FROM sums s JOIN pts p USING (sample_label, entity) WHERE normalized IS NOT NULL GROUP BY ALL),
scored AS (SELECT "group", replicate, sample_label, entity, CASE WHEN n = 2 THEN rise WHEN n > 2 THEN sxy / sxx END AS score,
             CASE WHEN n = 2 THEN se2 WHEN n > 2 THEN sqrt(greatest(0, syy - sxy / sxx * sxy) / (n - 2) / sxx) END AS se FROM devs),
final AS (SELECT "group", replicate, sample_label, entity, CASE WHEN abs(score) < 1e-10 THEN 0 ELSE score END AS enrichment_score, CASE WHEN abs(se) < 1e-10 THEN 0 ELSE se END AS standard_error
          FROM scored JOIN (SELECT sample_label, entity FROM dense GROUP BY 1, 2 HAVING sum((c > 0)::INT) > 1) USING (sample_label, entity) WHERE score IS NOT NULL)
"""


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.densify(T.entity_counts(spark, sf_dir))


def entity_timepoint_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by time point, missing counts 0."""
    return enrich.wide(_counts(spark, sf_dir), "timepoint", "c", list(T.TIMEPOINTS), ["sample_label", "entity"], "_count").fillna(0)


PIVOT = DENSE + ", p AS (SELECT sample_label, entity, " + ", ".join(f'coalesce(sum(c) FILTER (WHERE timepoint = {t}), 0)::BIGINT AS "{t}_count"' for t in T.TIMEPOINTS) + " FROM dense GROUP BY 1, 2) SELECT * FROM p"


def enrich_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log ratios to the sample total with the dropout mask, and weights."""
    n = enrich.normalise(_counts(spark, sf_dir))
    return n.select("sample_label", "entity", "timepoint", "c", F.round("normalized", 7).alias("normalized"), F.round("weight", 6).alias("weight"))


NORMALIZE = DENSE + "SELECT sample_label, entity, timepoint, c, round(normalized, 7) AS normalized, round(weight, 6) AS weight FROM normed"


def enrich_wls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted slopes and errors of every entity."""
    s = enrich.enrichment(_counts(spark, sf_dir))
    return s.select("sample_label", "replicate", "entity", F.round("enrichment_score", 6).alias("enrichment_score"), F.round("standard_error", 6).alias("standard_error"))


WLS = DENSE + "SELECT sample_label, replicate, entity, round(enrichment_score, 6) AS enrichment_score, round(standard_error, 6) AS standard_error FROM final"


def enrich_auto_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity that the others are compared with."""
    return enrich.auto_reference(_counts(spark, sf_dir))


AUTO = DENSE + """, k AS (SELECT entity FROM dense GROUP BY 1 HAVING min(c) > 0 AND count(DISTINCT sample_label) = (SELECT count(DISTINCT sample_label) FROM dense)),
e AS (SELECT entity, avg(c) FILTER (WHERE timepoint = (SELECT min(timepoint) FROM dense)) AS a, avg(c) FILTER (WHERE timepoint = (SELECT max(timepoint) FROM dense)) AS b FROM dense JOIN k USING (entity) GROUP BY 1),
f AS (SELECT * FROM e WHERE a >= (SELECT quantile_cont(a, 0.25) FROM e)), g AS (SELECT * FROM f WHERE b <= (SELECT quantile_cont(b, 0.25) FROM f))
SELECT entity FROM (SELECT *, 0 AS o FROM g UNION ALL SELECT *, 1 FROM e) ORDER BY o, b DESC, entity LIMIT 1"""


def enrich_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log ratios to one entity; samples that lack it use their totals."""
    ref = spark.createDataFrame([("click|1",)], "entity string")
    n = enrich.normalise(_counts(spark, sf_dir), ref)
    return n.groupBy("sample_label", "timepoint").agg(F.max("r").alias("r"), F.round(F.sum("normalized"), 5).alias("total"))


BY_REFERENCE = DENSE + """, o AS (SELECT sample_label, timepoint, sum(c)::DOUBLE AS own FROM dense WHERE entity = 'click|1' GROUP BY 1, 2),
z AS (SELECT dense.*, coalesce(own, r) AS rr, sum((c = 0)::INT) OVER (PARTITION BY sample_label, entity ORDER BY timepoint) AS zs FROM dense JOIN totals USING (sample_label, timepoint) LEFT JOIN o USING (sample_label, timepoint))
SELECT sample_label, timepoint, max(rr) AS r, round(sum(CASE WHEN zs < 2 THEN ln((c + 0.5::DOUBLE) / (rr + 0.5::DOUBLE)) END), 5) AS total FROM z GROUP BY 1, 2"""


def enrich_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate means without the tenth of the largest errors."""
    m = enrich.mean_scores(enrich.enrichment(_counts(spark, sf_dir)), se_share=0.1)
    return m.select("group", "entity", F.round("mean_enrichment_score", 6).alias("mean"), F.round("std_enrichment_score", 6).alias("std"), "valid_replicates")


MEAN = DENSE + """SELECT "group", entity, round(avg(enrichment_score), 6) AS mean, round(stddev_samp(enrichment_score), 6) AS std, count(*) AS valid_replicates
FROM final JOIN (SELECT replicate, quantile_cont(standard_error, 0.9) AS edge FROM final GROUP BY 1) USING (replicate) WHERE standard_error <= edge GROUP BY 1, 2"""


def enrich_mean_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate means whose deviation takes the mean as one more value."""
    m = enrich.mean_scores(enrich.enrichment(_counts(spark, sf_dir)), compat=True)
    return m.select("entity", F.round("mean_enrichment_score", 6).alias("mean"), F.round("std_enrichment_score", 6).alias("std"))


MEAN_COMPAT = DENSE + """, m AS (SELECT entity, avg(enrichment_score) AS s FROM final GROUP BY 1), v AS (SELECT entity, enrichment_score AS s FROM final UNION ALL SELECT * FROM m)
SELECT entity, round(any_value(m.s), 6) AS mean, round(stddev_samp(v.s), 6) AS std FROM v JOIN m USING (entity) GROUP BY 1"""


def replicate_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit and R squared of every two replicates."""
    a = enrich.replicate_agreement(enrich.enrichment(_counts(spark, sf_dir)).withColumn("replicate", F.col("sample_label")))
    return a.select("a", "b", "n", *(F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2", "r2_identity")))


AGREEMENT = DENSE + """, b AS (SELECT a.sample_label AS a, b.sample_label AS b, a.enrichment_score AS x, b.enrichment_score AS y FROM final a JOIN final b USING (entity) WHERE a.sample_label < b.sample_label)
SELECT a, b, count(*) AS n, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2, round(1 - sum((x - y) ** 2) / (var_pop(x) * count(*)), 6) AS r2_identity FROM b GROUP BY a, b"""


def timepoint_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout table with repeated labels as long rows."""
    rows = [(0, "A", "t_g1", "t_g2"), (1, "B", "u_g1", ""), (2, "A", "v_g1", "v_g2")]
    wide = spark.createDataFrame(rows, "row int, sample_label string, `50` string, `90` string")
    return enrich.timepoints(wide, ["50", "90"]).select("sample_label", F.col("replicate").cast("int").alias("replicate"), "timepoint", "tag", "barcode_group")


LAYOUT = """SELECT * FROM (VALUES ('A-rep1', 1, 50.0::DOUBLE, 't', 'g1'), ('A-rep1', 1, 90.0, 't', 'g2'), ('B', 1, 50.0, 'u', 'g1'), ('A-rep2', 2, 50.0, 'v', 'g1'), ('A-rep2', 2, 90.0, 'v', 'g2')) t(sample_label, replicate, timepoint, tag, barcode_group)"""


def left_merge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities' scores joined to all their counts; entities without a score stay."""
    s = enrich.enrichment(_counts(spark, sf_dir)).select("sample_label", "entity", F.round("enrichment_score", 6).alias("score"))
    n = _counts(spark, sf_dir).groupBy("sample_label", "entity").agg(F.sum("c").alias("reads"))
    return n.join(s, ["sample_label", "entity"], "left")


MERGE = DENSE + "SELECT sample_label, entity, sum(c)::BIGINT AS reads, round(any_value(enrichment_score), 6) AS score FROM dense LEFT JOIN final USING (sample_label, entity) GROUP BY 1, 2"


def merge_with_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes of labelled reads with the mean score of their label."""
    called = _kept(spark, sf_dir).withColumn("label_barcodes", (F.col("read_id").cast("long") % 3).cast("string"))
    made = variants.genotypes(called)
    scores = spark.createDataFrame([("g", f"{r}|{k}", k + (0.5 if r == "refB" else 0.0)) for r in ("refA", "refB") for k in range(2)], "group string, entity string, mean_enrichment_score double")
    out = enrich.merge_with_genotypes(variants.seq_ids(called, made), made, scores, ["g"])
    return out.groupBy("reference_name", "label_barcodes").agg(F.count("*").alias("rows"), F.max("g_score").alias("score"))


MERGED_GENOTYPES = CALLS + """, ids AS (SELECT DISTINCT CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS g, c.reference_name, (c.read_id::BIGINT % 3)::VARCHAR AS label_barcodes
  FROM called c JOIN ranked r USING (reference_name, NT_substitutions, NT_insertions, NT_deletions, AA_substitutions_nonsynonymous, AA_substitutions_synonymous))
SELECT reference_name, label_barcodes, count(*) AS rows, max(CASE WHEN label_barcodes IN ('0', '1') THEN label_barcodes::DOUBLE + CASE WHEN reference_name = 'refB' THEN 0.5 ELSE 0 END END) AS score FROM ids GROUP BY 1, 2"""


def quantile_filter_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the upper tenth of the price of their return flag."""
    d = T.table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("p"))
    return keep_quantile(d, "p", 0.9, by=["l_returnflag"]).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("p"), 2).alias("total"))


QUANTILE = """SELECT l_returnflag, count(*) AS n, round(sum(p), 2) AS total FROM (SELECT l_returnflag, l_extendedprice::DOUBLE AS p FROM lineitem)
JOIN (SELECT l_returnflag, quantile_cont(l_extendedprice::DOUBLE, 0.9) AS edge FROM lineitem GROUP BY 1) USING (l_returnflag) WHERE p >= edge GROUP BY 1"""


def quantile_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the lower quarter of the price."""
    d = T.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("p"))
    return keep_quantile(d, "p", 0.25, upper=False).select("o_orderkey")


QUANTILE_ALL = "SELECT o_orderkey FROM orders WHERE o_totalprice::DOUBLE <= (SELECT quantile_cont(o_totalprice::DOUBLE, 0.25) FROM orders)"


def genotype_abundance_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by order of magnitude of their customer's number of orders."""
    d = T.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("count"))
    b = diversity.abundance_bins(d)
    return b.select("x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


BINS = """WITH c AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey), b AS (SELECT CASE WHEN n <= 1 THEN 0 WHEN n <= 10 THEN 1 WHEN n <= 100 THEN 2 ELSE 3 END AS x, sum(n) AS t FROM c GROUP BY 1),
s AS (SELECT unnest(range(0, (SELECT max(x) FROM b) + 1)) AS x)
SELECT x::INT AS x, coalesce(t, 0)::BIGINT AS total, round(coalesce(t, 0) / sum(t) OVER (), 9) AS proportion, round(sum(coalesce(t, 0)) OVER (ORDER BY x) / sum(t) OVER (), 9) AS cumulative FROM s LEFT JOIN b USING (x)"""

#: Genotypes as sequences of 12 letters.
GENO = f"""
WITH g AS ({T.GENOTYPES}),
pts AS (SELECT id, n_reads, p, ('ATGCATGCATGC')[p] AS wt, CASE WHEN s1 <> '' AND substr(s1, 2, length(s1) - 2)::INT = p THEN right(s1, 1) WHEN s2 <> '' AND substr(s2, 2, length(s2) - 2)::INT = p THEN right(s2, 1) ELSE ('ATGCATGCATGC')[p] END AS c
        FROM g, range(1, 13) r(p)),
seqs AS (SELECT id, n_reads, string_agg(c, '' ORDER BY p) AS s FROM pts GROUP BY 1, 2),
muts AS (SELECT id, n_reads, p, wt, c, wt || p || c AS name FROM pts WHERE wt <> c)
"""


def _geno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.genotypes(spark, sf_dir).withColumn("points", diversity.parse_genotype(F.col("NT_substitutions")))


def _geno_ref(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("refA", T.GENOTYPE_REF)], "reference_name string, seq string")


def genotype_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence that every genotype spells, and its mutations called back."""
    g = _geno(spark, sf_dir).withColumn("ref", F.lit(T.GENOTYPE_REF)).withColumn("seq", diversity.apply_genotype(F.col("ref"), F.col("points")))
    return g.select("id", "seq").join(diversity.call_mutations(g), "id")


SEQUENCES = GENO + "SELECT id, s AS seq, coalesce(m, '') AS substitutions, '' AS deletions FROM seqs LEFT JOIN (SELECT id, string_agg(name, ', ' ORDER BY p) AS m FROM muts GROUP BY 1) USING (id)"


def identity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with each letter at each position."""
    return diversity.identities(_geno(spark, sf_dir), _geno_ref(spark), alphabet="ATGC").select("position", "wt", "mutation", "n")


IDENTITIES = GENO + "SELECT p AS position, wt, m AS mutation, sum(CASE WHEN c = m THEN n_reads ELSE 0 END)::BIGINT AS n FROM pts, (VALUES ('A'), ('T'), ('G'), ('C')) m(m) GROUP BY 1, 2, 3"


def consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest letter of every position."""
    return diversity.consensus(diversity.identities(_geno(spark, sf_dir), _geno_ref(spark)))


CONSENSUS = GENO + ", v AS (SELECT p, arg_max(c, n * 10 - strpos('ATGC', c)) AS c FROM (SELECT p, c, sum(n_reads) AS n FROM pts GROUP BY 1, 2) GROUP BY 1) SELECT 'refA' AS reference_name, string_agg(c, '' ORDER BY p) AS consensus FROM v"


def hamming_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all pairs of reads."""
    d = distances.hamming_distribution(_geno(spark, sf_dir))
    return d.select("x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


def _distances(weight: str) -> str:
    return GENO + f""", d AS (SELECT hamming(a.s, b.s) AS x, sum({weight})::BIGINT AS w FROM seqs a JOIN seqs b ON a.id > b.id GROUP BY 1 UNION ALL SELECT 0, sum(n_reads * (n_reads - 1) / 2)::BIGINT FROM seqs),
t AS (SELECT x, sum(w) AS w FROM d GROUP BY 1), s AS (SELECT unnest(range(0, (SELECT max(x) FROM t WHERE w > 0) + 1)) AS x)
SELECT x::INT AS x, coalesce(w, 0)::BIGINT AS total, round(coalesce(w, 0) / sum(w) OVER (), 9) AS proportion, round(sum(coalesce(w, 0)) OVER (ORDER BY x) / sum(w) OVER (), 9) AS cumulative FROM s LEFT JOIN t USING (x)"""


def hamming_distribution_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances with every pair counted by its later genotype alone."""
    d = distances.hamming_distribution(_geno(spark, sf_dir), compat=True)
    return d.select("x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


_WANTED = "A1G, 3, G_, _C, A_T"


def moi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes labelled by their changes of interest."""
    return diversity.label_interest(_geno(spark, sf_dir), _WANTED, 4).select("id", "label")


MOI = GENO + """, h AS (SELECT id, string_agg(name, ', ' ORDER BY p) AS t FROM muts WHERE name = 'A1G' OR p = 3 OR wt = 'G' OR c = 'C' OR wt = 'A' AND c = 'T' GROUP BY 1),
k AS (SELECT t FROM h GROUP BY 1 ORDER BY count(*) DESC, t LIMIT 4)
SELECT g.id, CASE WHEN h.t IS NULL THEN 'none' WHEN h.t IN (SELECT t FROM k) THEN h.t ELSE 'other' END AS label FROM g LEFT JOIN h USING (id)"""


def conspicuous_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the five positions with most changes."""
    tidy = variants.tidy_counts(_called(spark, sf_dir), T.references(spark))
    return diversity.conspicuous(tidy, 5).select("reference_name", "position", "mutation", F.coalesce("total_count", F.lit(-1)).cast("long").alias("total_count"))


CONSPICUOUS = CALLS + """, r AS (SELECT reference_name, position, row_number() OVER (PARTITION BY reference_name ORDER BY sum(CASE WHEN wt <> mutation THEN n END) DESC, position) AS r FROM tidy GROUP BY 1, 2)
SELECT reference_name, position, mutation, CASE WHEN wt <> mutation THEN n ELSE -1 END AS total_count FROM tidy JOIN r USING (reference_name, position) WHERE r <= 5"""


def deletion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive order keys per status."""
    return runs(T.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], "o_orderkey")


RUNS = 'SELECT o_orderstatus, min(o_orderkey) AS "first", count(*) AS length FROM (SELECT *, o_orderkey - row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS g FROM orders) GROUP BY o_orderstatus, g'

_STATS_SQL = "SELECT CAST(floor(extract(month FROM o_orderdate)) AS INT) AS m, CASE WHEN o_custkey % 2 = 0 THEN 's0' ELSE 's1' END AS sample_label, count(*) AS total_seqs, " + ", ".join(
    f"sum(CASE WHEN o_orderkey % 12 = {k} THEN 1 + o_custkey % 3 ELSE 0 END) AS c{k}" for k in range(12)
) + " FROM orders GROUP BY 1, 2"


def _stat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = T._with_views(spark, sf_dir, _STATS_SQL, ("orders",))
    named = df.select(F.col("m").cast("double").alias("timepoint"), "sample_label", F.lit(1).alias("replicate"), "total_seqs", *(F.col(f"c{k}").alias(c) for k, c in enumerate(stats.CHANGES)))
    total = sum((F.col(f"`{c}`") for c in stats.CHANGES[1:]), F.col(f"`{stats.CHANGES[0]}`"))
    return named.withColumn("total_NT_mutations", total)


_FACTOR = rates.base_factors(T._NT_A)
_LONG = f"WITH s AS ({_STATS_SQL}), v AS (SELECT m, sample_label, total_seqs, unnest([" + ", ".join(
    f"{{'t': '{c}', 'v': {_FACTOR[c[0]]!r}::DOUBLE * c{k} / (total_seqs * 48), 'n': c{k}}}" for k, c in enumerate(stats.CHANGES)
) + "]) AS u FROM s)"


def mutation_rate_regr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slopes of normalised mutations over months, for every change and for all."""
    values = rates.per_base(_stat_rows(spark, sf_dir).drop("total_NT_mutations"), T._NT_A)
    r = rates.rates(values)
    return r.select("sample_label", "mut_type", F.round("rate", 9).alias("rate"), F.round("intercept", 9).alias("intercept"), F.round("r_value", 6).alias("r_value"), F.round("std_err", 9).alias("std_err"))


RATE = _LONG + """, a AS (SELECT m, sample_label, u.t AS mut_type, u.v AS v FROM v UNION ALL SELECT m, sample_label, 'all', sum(u.v) FROM v GROUP BY 1, 2)
SELECT sample_label, mut_type, round(regr_slope(v, m), 9) AS rate, round(regr_intercept(v, m), 9) AS intercept, round(corr(m, v), 6) AS r_value,
round(sqrt((regr_syy(v, m) - regr_sxy(v, m) ** 2 / regr_sxx(v, m)) / (count(*) - 2) / regr_sxx(v, m)), 9) AS std_err FROM a GROUP BY 1, 2"""


def mutation_rate_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fits with p-values, which SQL cannot give."""
    values = rates.per_base(_stat_rows(spark, sf_dir).drop("total_NT_mutations"), T._NT_A)
    return rates.with_p_value(rates.rates(values))


def mutation_rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of both samples as replicates of one."""
    values = rates.per_base(_stat_rows(spark, sf_dir).drop("total_NT_mutations"), T._NT_A)
    fits = rates.rates(values).withColumn("sample_label", F.lit("s"))
    return rates.rate_summary(fits).select("mut_type", "n", F.round("mean", 9).alias("mean"), F.round("median", 9).alias("median"), F.round("q25", 9).alias("q25"))


RATE_SUMMARY = _LONG + """, a AS (SELECT m, sample_label, u.t AS mut_type, u.v AS v FROM v UNION ALL SELECT m, sample_label, 'all', sum(u.v) FROM v GROUP BY 1, 2),
r AS (SELECT sample_label, mut_type, greatest(regr_slope(v, m), 1e-10) AS r FROM a GROUP BY 1, 2)
SELECT mut_type, count(*) AS n, round(CASE WHEN avg(r) > 1e-8 THEN avg(r) END, 9) AS mean, round(CASE WHEN quantile_cont(r, 0.5) > 1e-8 THEN quantile_cont(r, 0.5) END, 9) AS median, round(quantile_cont(r, 0.25), 9) AS q25 FROM r GROUP BY 1"""


def mutation_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the twelve changes, normalised to bases."""
    s = rates.spectrum(_stat_rows(spark, sf_dir), T._NT_A)
    return s.select("sample_label", F.col("timepoint").cast("int").alias("m"), "wt_nt", "mut_nt", F.round("share", 9).alias("share"))


_RAW = "WITH s AS (" + _STATS_SQL + "), v AS (SELECT m, sample_label, unnest([" + ", ".join(f"{{'t': '{c}', 'v': {_FACTOR[c[0]]!r}::DOUBLE * c{k}}}" for k, c in enumerate(stats.CHANGES)) + "]) AS u FROM s)"
SPECTRUM = _RAW + " SELECT sample_label, m, left(u.t, 1) AS wt_nt, right(u.t, 1) AS mut_nt, round(u.v / sum(u.v) OVER (PARTITION BY m, sample_label), 9) AS share FROM v"


def melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order columns as long rows."""
    d = T.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), F.col("o_totalprice").cast("double").alias("o_totalprice"))
    return d.unpivot(["o_orderkey"], ["o_custkey", "o_totalprice"], "variable", "value")


MELT = "SELECT o_orderkey, 'o_custkey' AS variable, o_custkey::DOUBLE AS value FROM orders UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice::DOUBLE FROM orders"


def union_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as one list with their origin."""
    c = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))
    s = T.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))
    return label_union({"customer": c, "supplier": s}, "origin")


UNION = "SELECT c_custkey AS key, c_nationkey AS nation, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, s_nationkey, 'supplier' FROM supplier"


def reference_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nations with most customers."""
    d = T.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("reference_name"), F.lit(1).alias("count"))
    return stats.reference_abundance(d, 5)


ABUNDANCE = "SELECT c_nationkey AS reference_name, count(*) AS total FROM customer GROUP BY 1 ORDER BY total DESC, 1 LIMIT 5"


def point_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices scaled to point sizes."""
    d = T.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("p"))
    return stats.point_sizes(d, "p").select("o_orderkey", F.round("point_size", 6).alias("point_size"))


SIZES = "SELECT o_orderkey, round(1 + (o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) * 19, 6) AS point_size FROM orders"


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and seconds of every stage, each run once; the seconds, which differ, as whether they were taken."""
    watch = stats.Stopwatch(spark)
    reads = watch.step("reads", T.reads(spark, sf_dir))
    trimmed = watch.step("trimmed", variants.trim(reads, T.references(spark)))
    called = watch.step("called", variants.call(trimmed, MIN_Q))
    watch.step("genotypes", variants.genotypes(called))
    return watch.table().select("pipeline_step", "sequences", (F.col("seconds") > 0).alias("timed"))


THROUGHPUT = CALLS + """SELECT 'reads' AS pipeline_step, count(*) AS sequences, TRUE AS timed FROM reads UNION ALL SELECT 'trimmed', count(*), TRUE FROM reads
UNION ALL SELECT 'called', count(*), TRUE FROM called UNION ALL SELECT 'genotypes', count(*), TRUE FROM condensed"""


def log_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "orders")
    return d.select("o_orderkey", F.round(S.log_fraction(F.col("o_custkey"), F.col("o_orderkey")), 9).alias("ratio"), S.entity_id("o_orderkey", "o_orderstatus").alias("entity"), S.in_ranges(F.col("o_orderkey"), "20-30,50").alias("chosen"))


FRACTIONS = "SELECT o_orderkey, round(ln((o_custkey + 0.5::DOUBLE) / (o_orderkey + 0.5::DOUBLE)), 9) AS ratio, o_orderkey || '|' || o_orderstatus AS entity, o_orderkey BETWEEN 20 AND 30 OR o_orderkey = 50 AS chosen FROM orders"


def sampled_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty genotypes drawn by their reads without replacement."""
    return weighted_sample(_geno(spark, sf_dir).select("id", "count", "NT_substitutions"), 50, "count").select("id", "count")


SAMPLED = f"""WITH g AS (SELECT id, n_reads AS "count", concat_ws(', ', nullif(s1, ''), nullif(s2, '')) AS t FROM ({T.GENOTYPES})),
d AS (SELECT *, concat_ws('|', '0', id, "count", t) AS row_text FROM g)
SELECT id, "count" FROM d ORDER BY -ln((('0x' || substr(md5(row_text), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE) / "count", row_text LIMIT 50"""


def genotype_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two principal components of the genotypes."""
    return diversity.embed(_geno(spark, sf_dir)).select("id", "PCA1", "PCA2")


def genotype_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest others of every genotype, by descent over a neighbour graph."""
    return manifold.neighbours(_geno(spark, sf_dir), by=()).select("id", "neighbour", "distance")


def genotype_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genotypes in the plane, neighbours kept together."""
    return manifold.embed(_geno(spark, sf_dir), by=()).select("id", "EMB1", "EMB2")


QUERIES = {
    f.__name__: (f, sql)
    for f, sql in (
        (entity_timepoint_pivot, PIVOT), (enrich_normalize, NORMALIZE), (enrich_wls, WLS), (enrich_auto_reference, AUTO), (enrich_by_reference, BY_REFERENCE), (enrich_mean, MEAN),
        (enrich_mean_compat, MEAN_COMPAT), (replicate_agreement, AGREEMENT), (timepoint_layout, LAYOUT), (left_merge_scores, MERGE), (merge_with_genotypes, MERGED_GENOTYPES),
        (quantile_filter_grouped, QUANTILE), (quantile_filter, QUANTILE_ALL), (genotype_abundance_bins, BINS), (genotype_sequences, SEQUENCES), (identity_counts, IDENTITIES),
        (consensus, CONSENSUS), (hamming_distribution, _distances("a.n_reads * b.n_reads")), (hamming_distribution_compat, _distances("a.n_reads")), (moi_labels, MOI),
        (conspicuous_positions, CONSPICUOUS), (deletion_runs, RUNS), (mutation_rate_regr, RATE), (mutation_rate_p, None), (mutation_rate_summary, RATE_SUMMARY),
        (mutation_spectrum, SPECTRUM), (melt, MELT), (union_label, UNION), (reference_abundance, ABUNDANCE), (point_sizes, SIZES), (throughput, THROUGHPUT),
        (log_fractions, FRACTIONS), (sampled_genotypes, SAMPLED), (genotype_pca, None), (genotype_neighbours, None), (genotype_embedding, None),
    )
}
