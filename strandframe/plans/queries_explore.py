"""Queries of a viewer: selections, traces, summaries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.operators import diversity, explore, selections, variants
from strandframe.plans import synthetic as T
from strandframe.plans.queries_sequence import CALLS, _called, _kept


def selected_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes of one reference with one or two substitutions, five reads or more and no indels."""
    g = variants.genotypes(_called(spark, sf_dir))
    out = explore.select_genotypes(g, "refA", {"NT_substitutions_count": (1, 2), "count": (5, 1e9)}, exclude_indels=True)
    return out.select("genotype_ID", "NT_substitutions", "count")


SELECTED = CALLS + """SELECT CASE WHEN wild THEN 'wildtype' ELSE genotype_rank::VARCHAR END AS genotype_ID, NT_substitutions, "count" FROM ranked
WHERE reference_name = 'refA' AND NT_substitutions_count BETWEEN 1 AND 2 AND "count" >= 5 AND NT_insertions = '' AND NT_deletions = ''"""


def indexed_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes changed in the first or second ten positions but not in the next ten, by bitmaps of letters and labels."""
    g = variants.genotypes(_called(spark, sf_dir)).withColumn("points", diversity.parse_genotype(F.col("NT_substitutions")))
    built = selections.index(g, ("reference_name", "NT_insertions"), "called")
    ten = lambda k: [selections.letter(p, c) for p in range(k, k + 10) for c in "ACGT"]
    having = [[*ten(0), *ten(10)], [selections.label("NT_insertions", "")]]
    chosen = built.select(having, ten(20)).select("reference_name", "NT_substitutions", "NT_deletions", "count")
    # How many there are, by the bitmaps alone, beside each.
    return chosen.join(F.broadcast(built.count(having, ten(20)).withColumnRenamed("n", "selected")), F.lit(True), "left")


INDEXED = CALLS + """SELECT reference_name, NT_substitutions, NT_deletions, "count", count(*) OVER () AS selected FROM ranked
WHERE NT_insertions = '' AND regexp_matches(NT_substitutions, '(^|, )[A-Z]([1-9]|1[0-9]|20)[ACGT](,|$)') AND NOT regexp_matches(NT_substitutions, '(^|, )[A-Z](2[1-9]|30)[ACGT](,|$)')"""


def sequence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads behind the genotypes of every reference."""
    return explore.count_sequences(variants.genotypes(_called(spark, sf_dir)), ["reference_name"])


COUNTS = CALLS + "SELECT reference_name, count(*) AS sequences FROM called GROUP BY 1"


def read_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and quality of the reads of every reference."""
    r = explore.read_summary(T.reads(spark, sf_dir).withColumn("seq", F.col("query_seq")), ["reference_name"])
    return r.select("reference_name", "reads", "bases", F.round("mean_length", 6).alias("mean_length"), "median_length", F.round("mean_quality", 6).alias("mean_quality"), "n50")


SUMMARY = CALLS + f""", n AS (SELECT reference_name, read_id, length(query_seq) AS n, CASE WHEN cigar LIKE '3S%' THEN 3 ELSE 0 END AS clipped FROM reads),
q AS (SELECT reference_name, sum(CASE WHEN i <= 0 THEN 2 ELSE {T.QUALITY} END) AS q FROM (SELECT reference_name, read_id, unnest(range(1 - clipped, n - clipped + 1)) AS i FROM n) GROUP BY 1),
s AS (SELECT reference_name, n, sum(n * k) OVER (PARTITION BY reference_name ORDER BY n DESC) AS seen, sum(n * k) OVER (PARTITION BY reference_name) AS total FROM (SELECT reference_name, n, count(*) AS k FROM n GROUP BY 1, 2))
SELECT reference_name, count(*) AS reads, sum(n)::BIGINT AS bases, round(avg(n), 6) AS mean_length, quantile_cont(n::DOUBLE, 0.5) AS median_length, round(any_value(q) / sum(n), 6) AS mean_quality, any_value(n50)::BIGINT AS n50
FROM n JOIN q USING (reference_name) JOIN (SELECT reference_name, max(n) AS n50 FROM s WHERE seen * 2 >= total GROUP BY 1) USING (reference_name) GROUP BY 1"""


def traced_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads behind the most abundant mutated genotype, along the reference."""
    called = _kept(spark, sf_dir)
    ids = variants.seq_ids(called, variants.genotypes(called))
    return explore.trace_reads(T.reads(spark, sf_dir), ids, T.references(spark), "1")


TRACED = CALLS + """, o AS (SELECT read_id, k, CASE op WHEN 'D' THEN repeat('-', n) WHEN 'I' THEN lower(substr(query_seq, q0 + 1, n)) WHEN 'M' THEN substr(query_seq, q0 + 1, n) ELSE '' END AS t FROM offs JOIN reads USING (read_id))
SELECT c.read_id, c.reference_name, repeat('-', any_value(r.ref_start)) || string_agg(t, '' ORDER BY k) AS aligned
FROM called c JOIN ranked g USING (reference_name, NT_substitutions, NT_insertions, NT_deletions, AA_substitutions_nonsynonymous, AA_substitutions_synonymous) JOIN reads r USING (read_id) JOIN o USING (read_id)
WHERE genotype_rank = 1 AND NOT wild GROUP BY c.read_id, c.reference_name"""


def position_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed reads of every position."""
    p = diversity.position_profile(variants.tidy_counts(_called(spark, sf_dir), T.references(spark)))
    return p.select("reference_name", "wt", "position", "total_count", F.round("frequency", 8).alias("frequency"))


PROFILE = CALLS + "SELECT reference_name, wt, position, sum(CASE WHEN wt <> mutation THEN n END)::BIGINT AS total_count, round(sum(CASE WHEN wt <> mutation THEN n END) / any_value(seqs), 8) AS frequency FROM tidy GROUP BY 1, 2, 3"


def integer_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences as numbers, and back."""
    d = T.tagged(spark, sf_dir).select("read_id", explore.encode(F.col("query"), S.NT_ALPHABET).alias("codes"))
    return d.select("read_id", F.array_join(F.transform("codes", lambda x: x.cast("string")), "").alias("codes"), explore.decode(F.col("codes"), S.NT_ALPHABET).alias("seq"))


ENCODING = f"SELECT read_id, translate(query, 'ATGC-N', '012345') AS codes, query AS seq FROM ({T.TAGGED})"


def demux_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type, the shape of a partitioned write."""
    d = T.table(spark, sf_dir, "events")
    return d.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


PARTITIONS = "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"

QUERIES = {
    f.__name__: (f, sql)
    for f, sql in (
        (selected_genotypes, SELECTED), (indexed_selection, INDEXED), (sequence_counts, COUNTS), (read_summary, SUMMARY), (traced_reads, TRACED), (position_profile, PROFILE),
        (integer_encoding, ENCODING), (demux_partitions, PARTITIONS),
    )
}
