"""Queries on barcodes, demultiplexing and UMIs, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import seq as S
from strandframe.operators import consensus, demux, umi
from strandframe.operators.common import missing, top
from strandframe.plans import synthetic as T

_FAILS = demux.FAILS
_W = {t: ", ".join(f"({k}, '{t[0]}{k + 1}', '{s}')" for k, s in enumerate(seqs)) for t, seqs in T._WORDS.items()}
#: Contexts are CCGNNNNNGCA (barcode at 3..8) and TTANNNNGAC (at 3..7); both found by plain search.
IDENTIFIED = f"""
WITH fw(ord, name, seq) AS (VALUES {_W['fwd']}), rw(ord, name, seq) AS (VALUES {_W['rvs']}),
reads AS ({T.TAGGED}),
spots AS (SELECT *, strpos(gapped_ref, 'CCGNNNNNGCA') - 1 AS f, strpos(gapped_ref, 'TTANNNNGAC') - 1 AS r FROM reads),
cut AS (SELECT *, CASE WHEN f >= 0 THEN substr(query, f + 4, 5) END AS fseq, CASE WHEN r >= 0 THEN substr(query, r + 4, 4) END AS rseq FROM spots),
near AS (SELECT fseq, arg_min(name, hamming(fseq, seq) * 100 + ord) FILTER (WHERE hamming(fseq, seq) <= 1) AS name, min(hamming(fseq, seq)) AS d
         FROM (SELECT DISTINCT fseq FROM cut WHERE fseq IS NOT NULL), fw GROUP BY 1),
named AS (SELECT c.*, coalesce(near.name, 'fail') AS fwd, coalesce(rw.name, 'fail') AS rvs,
            CASE WHEN near.name IS NOT NULL AND d > 0 THEN 1 ELSE 0 END AS "fwd:not_exact_match", CASE WHEN f < 0 THEN 1 ELSE 0 END AS "fwd_failed:{_FAILS[0]}",
            CASE WHEN f >= 0 AND near.name IS NULL THEN 1 ELSE 0 END AS "fwd_failed:{_FAILS[1]}", 0 AS "fwd_failed:{_FAILS[2]}",
            0 AS "rvs:not_exact_match", CASE WHEN r < 0 THEN 1 ELSE 0 END AS "rvs_failed:{_FAILS[0]}",
            CASE WHEN r >= 0 AND rw.name IS NULL THEN 1 ELSE 0 END AS "rvs_failed:{_FAILS[1]}", 0 AS "rvs_failed:{_FAILS[2]}"
          FROM cut c LEFT JOIN near USING (fseq) LEFT JOIN rw ON rw.seq = c.rseq),
grouped AS (SELECT *, CASE fwd WHEN 'f1' THEN 'g1' WHEN 'f2' THEN 'g2' WHEN 'f3' THEN 'g3' ELSE fwd END AS output_file_barcodes, fwd IN ('f1', 'f2', 'f3') AS named_by_group,
              CASE rvs WHEN 'r1' THEN 'l1' WHEN 'r2' THEN 'l2' ELSE rvs END AS label_barcodes FROM named)
"""
_COUNTERS = [f"{t}{s}" for t in ("fwd", "rvs") for s in (":not_exact_match", *(f"_failed:{f}" for f in _FAILS))]
_SUMS = ", ".join(f'sum("{c}")::BIGINT AS "{c}"' for c in _COUNTERS)
_ZEROS = ", ".join(f'0::BIGINT AS "{c}"' for c in _COUNTERS)
DEMUX = IDENTIFIED + f"""
, counted AS (SELECT tag, output_file_barcodes, named_by_group, reference_name, fwd, rvs, label_barcodes, count(*) AS barcodes_count, {_SUMS} FROM grouped GROUP BY ALL),
stats AS (SELECT *, sum(barcodes_count) OVER (PARTITION BY tag, output_file_barcodes)::BIGINT AS demuxed_count FROM counted
UNION ALL BY NAME
SELECT tag, g AS output_file_barcodes, TRUE AS named_by_group, 'n/a' AS reference_name, 'n/a' AS fwd, 'n/a' AS rvs, 'none' AS label_barcodes, 0::BIGINT AS barcodes_count, {_ZEROS}, 0::BIGINT AS demuxed_count
FROM (SELECT DISTINCT tag FROM counted), (VALUES ('g1'), ('g2'), ('g3'), ('g1b'), ('gx')) g(g)
WHERE NOT EXISTS (SELECT 1 FROM counted c WHERE c.output_file_barcodes = g AND c.tag = tag AND c.named_by_group))
"""


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demux.identify(T.tagged(spark, sf_dir), T.words(spark), T.BARCODES)


def _demuxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demux.demultiplex(_identified(spark, sf_dir), T.BARCODES, T.groups(spark), T.groups(spark, T.LABELS))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demux.statistics(_demuxed(spark, sf_dir), T.BARCODES, T.groups(spark))


def barcode_identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both barcodes of every read, exact or within one mismatch, with the counters."""
    out = _identified(spark, sf_dir)
    return out.select("read_id", "fwd", "rvs", *(F.col(f"`{c}`").cast("int").alias(c) for c in _COUNTERS))


IDENTIFY = IDENTIFIED + "SELECT read_id, fwd, rvs, " + ", ".join(f'"{c}"' for c in _COUNTERS) + " FROM named"


def barcode_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by exact barcode."""
    w = F.broadcast(T.words(spark).filter("barcode_type = 'fwd'").select(F.col("seq").alias("b"), "name"))
    reads = T.tagged(spark, sf_dir).withColumn("b", F.substring("query", 6, 5))
    return reads.join(w, "b", "left").groupBy(F.coalesce("name", F.lit("fail")).alias("name")).agg(F.count("*").alias("n"))


EXACT = f"WITH w(o, name, seq) AS (VALUES {_W['fwd']}) SELECT coalesce(name, 'fail') AS name, count(*) AS n FROM ({T.TAGGED}) LEFT JOIN w ON seq = substr(query, 6, 5) GROUP BY 1"


def _umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "orders")
    h = F.translate(F.substring(F.md5(F.col("o_custkey").cast("string").cast("binary")), 1, 8), "0123456789abcdef", "ACGTACGTACGTACGT")
    return d.select(F.col("o_orderkey").cast("string").alias("read_id"), (F.col("o_orderkey") % 2).cast("string").alias("reference_name"), h.alias("umi"), "o_custkey", "o_orderkey", "o_totalprice")


_UMI = "translate(substr(md5(o_custkey::VARCHAR), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def barcode_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every different 8-letter code, the nearest of the codes of the first 40 customers within two mismatches."""
    q = _umis(spark, sf_dir).select(F.lit("x").alias("barcode_type"), F.col("umi").alias("seq")).distinct()
    code = F.translate(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 8), "0123456789abcdef", "ACGTACGTACGTACGT")
    w = spark.range(40).select(F.lit("x").alias("barcode_type"), F.col("id").alias("ord"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("name"), code.alias("seq"))
    return demux.nearest(q, w, 2).select("seq", "name", F.col("distance").cast("long").alias("distance"))


NEAREST = f"""WITH w AS (SELECT k, 'w' || k AS name, translate(substr(md5(k::VARCHAR), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS word FROM range(0, 40) r(k))
SELECT seq, arg_min(name, hamming(seq, word) * 1000 + k) AS name, min(hamming(seq, word))::BIGINT AS distance FROM (SELECT DISTINCT {_UMI} AS seq FROM orders), w WHERE hamming(seq, word) <= 2 GROUP BY 1"""


def barcode_group_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by tag, file, label and whether a group names the file."""
    return _demuxed(spark, sf_dir).groupBy("tag", "output_file_barcodes", "named_by_group", "label_barcodes").agg(F.count("*").alias("n"))


GROUPED = IDENTIFIED + "SELECT tag, output_file_barcodes, named_by_group, label_barcodes, count(*) AS n FROM grouped GROUP BY ALL"


def demux_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demultiplexing statistics with zero rows for empty groups."""
    return _stats(spark, sf_dir)


STATS = DEMUX + "SELECT * FROM stats"


def demux_banish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files left out: under a fifth of the tag's reads, a failed barcode, or no group."""
    return demux.banished(_stats(spark, sf_dir), T.BARCODES, 0.2, True, True)


BANISH = DEMUX + """
SELECT tag, output_file_barcodes FROM (SELECT *, sum(barcodes_count) OVER (PARTITION BY tag) AS total FROM stats) x WHERE demuxed_count > 0
GROUP BY 1, 2 HAVING bool_or(demuxed_count < 0.2 * total OR fwd = 'fail' OR rvs = 'fail' AND barcodes_count = demuxed_count OR NOT named_by_group)"""


def demux_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected groups without reads."""
    return _stats(spark, sf_dir).filter("demuxed_count = 0").select("tag", "output_file_barcodes")


ZERO = DEMUX + "SELECT tag, output_file_barcodes FROM stats WHERE demuxed_count = 0"


def label_barcode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label combinations, reads, failed and successful reads per file."""
    return demux.label_statistics(_stats(spark, sf_dir), T.BARCODES)


LABELS = DEMUX + """SELECT tag, output_file_barcodes, count(DISTINCT label_barcodes) AS unique_labels, sum(barcodes_count)::BIGINT AS total,
sum(CASE WHEN rvs = 'fail' THEN barcodes_count ELSE 0 END)::BIGINT AS failed, sum(CASE WHEN rvs = 'fail' THEN 0 ELSE barcodes_count END)::BIGINT AS success FROM stats WHERE barcodes_count > 0 GROUP BY 1, 2"""


def top_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of the most frequent reference only."""
    return demux.top_references(T.tagged(spark, sf_dir), 1).groupBy("reference_name").agg(F.count("*").alias("n"))


TOP_REFS = f"SELECT reference_name, count(*) AS n FROM ({T.TAGGED}) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1"


def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order."""
    orders = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return missing(T.table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey")


ANTI = "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"


def barcode_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest ten codes as a new dictionary."""
    found = _umis(spark, sf_dir).select(F.lit("new").alias("barcode_type"), F.substring("umi", 1, 4).alias("seq"))
    return demux.discover(found, 10).select("name", "seq", "count")


DISCOVERY = f"""SELECT 'bc' || row_number() OVER (ORDER BY n DESC, seq) AS name, seq, n AS "count" FROM (SELECT substr({_UMI}, 1, 4) AS seq, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, seq LIMIT 10"""


def coverage_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by order of magnitude of their orders."""
    d = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("reference_name"), F.lit(1).alias("barcodes_count"))
    return demux.coverage_bins(d).select(F.col("log10_bin").cast("int").alias("log10_bin"), "references")


COVERAGE = 'SELECT (length(n::VARCHAR) - 1)::INT AS log10_bin, count(*) AS "references" FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1'


def umi_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMIs of two contexts, with failures."""
    out = umi.extract(T.tagged(spark, sf_dir), [b.context for b in T.BARCODES])
    return out.select("read_id", "umi", "success", "failure", "umi_1_failure", "umi_2_failure")


EXTRACT = IDENTIFIED + """SELECT read_id, CASE WHEN f >= 0 AND r >= 0 THEN fseq || rseq ELSE '' END AS umi, (f >= 0 AND r >= 0)::INT::BIGINT AS success, (f < 0 OR r < 0)::INT::BIGINT AS failure,
(f < 0)::INT::BIGINT AS umi_1_failure, (r < 0)::INT::BIGINT AS umi_2_failure FROM cut"""


def umi_extract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.extract_summary(umi.extract(T.tagged(spark, sf_dir), [b.context for b in T.BARCODES]), 2)


SUMMARY = IDENTIFIED + """SELECT tag, reference_name, sum((f >= 0 AND r >= 0)::INT)::BIGINT AS success, sum((f < 0 OR r < 0)::INT)::BIGINT AS failure,
sum((f < 0)::INT)::BIGINT AS umi_1_failure, sum((r < 0)::INT)::BIGINT AS umi_2_failure FROM cut GROUP BY 1, 2"""


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads grouped by customer, as if that were their UMI group."""
    d = T.table(spark, sf_dir, "orders")
    strand = F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise("+")
    return d.select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 2).cast("string").alias("reference_name"), F.col("o_custkey").alias("unique_id"), strand.alias("strand"), F.col("o_totalprice").alias("quality"))


def umi_group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of orders per customer group."""
    g = _grouped(spark, sf_dir).groupBy("reference_name", "unique_id").agg(F.count("*").alias("final_umi_count"))
    out = umi.group_sizes(g)
    return out.select("reference_name", "x", "total", F.round("proportion", 9).alias("proportion"), F.round("cumulative", 9).alias("cumulative"))


GROUP_SIZES = """WITH g AS (SELECT (o_custkey % 2)::VARCHAR AS reference_name, count(*) AS n FROM orders GROUP BY o_custkey, 1),
s AS (SELECT reference_name, unnest(range(1, top + 1)) AS x FROM (SELECT reference_name, max(n) AS top FROM g GROUP BY 1))
SELECT reference_name, x::INT AS x, coalesce(c, 0)::BIGINT AS total, round(coalesce(c, 0) / sum(c) OVER p, 9) AS proportion, round(sum(coalesce(c, 0)) OVER (p ORDER BY x) / sum(c) OVER p, 9) AS cumulative
FROM s LEFT JOIN (SELECT reference_name, n AS x, count(*) AS c FROM g GROUP BY 1, 2) USING (reference_name, x) WINDOW p AS (PARTITION BY reference_name)"""


def umi_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of 5 reads or more cut to 8, strands in balance."""
    return umi.downsample(_grouped(spark, sf_dir), 5, 8, batches=4).select("read_id", "unique_id", "strand", "batch", "read_name")


DOWNSAMPLE = """WITH g AS (SELECT o_orderkey AS read_id, (o_custkey % 2)::VARCHAR AS reference_name, o_custkey AS unique_id, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand, o_totalprice AS quality FROM orders),
n AS (SELECT *, count(*) FILTER (WHERE strand = '+') OVER w AS p, count(*) FILTER (WHERE strand = '-') OVER w AS m, row_number() OVER (PARTITION BY unique_id, strand ORDER BY quality DESC, read_id) AS r FROM g WINDOW w AS (PARTITION BY unique_id)),
k AS (SELECT *, CASE WHEN least(p, 4) + least(m, 8 - least(p, 4)) < 8 THEN least(p, 8 - least(m, 8 - least(p, 4))) ELSE least(p, 4) END AS kp, least(m, 8 - least(p, 4)) AS km FROM n WHERE p + m >= 5)
SELECT read_id, unique_id, strand, unique_id % 4 AS batch, 'UMI-' || unique_id || '|ref-' || reference_name || '|' || read_id AS read_name FROM k WHERE r <= CASE WHEN strand = '+' THEN kp ELSE km END"""


def umi_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of a column filled within the group only."""
    from strandframe.operators.common import fill_both_ways

    g = _grouped(spark, sf_dir).withColumn("v", F.when(F.col("read_id") % 4 == 0, F.col("read_id")))
    return fill_both_ways(g, ["unique_id"], "read_id", "v").select("read_id", "v")


FFILL = """SELECT o_orderkey AS read_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
first_value(v IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey END AS v FROM orders)"""


def umi_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directional clusters of all codes."""
    u = _umis(spark, sf_dir).groupBy("reference_name", "umi").agg(F.count("*").alias("umi_count"))
    return umi.cluster(u, 1)


CLUSTERS = f"""WITH RECURSIVE u AS (SELECT (o_orderkey % 2)::VARCHAR AS reference_name, {_UMI} AS umi, count(*) AS n FROM orders GROUP BY 1, 2),
up AS (SELECT a.reference_name, a.umi, first(b.umi ORDER BY b.n DESC, b.umi) AS parent FROM u a JOIN u b ON a.reference_name = b.reference_name AND a.umi <> b.umi AND hamming(a.umi, b.umi) <= 1
       AND b.n >= 2 * a.n - 1 AND (b.n > a.n OR b.n = a.n AND b.umi < a.umi) GROUP BY 1, 2),
walk AS (SELECT reference_name, umi, umi AS at FROM u UNION ALL SELECT w.reference_name, w.umi, up.parent FROM walk w JOIN up ON up.reference_name = w.reference_name AND up.umi = w.at),
roots AS (SELECT w.reference_name, w.umi, w.at AS final_umi FROM walk w LEFT JOIN up ON up.reference_name = w.reference_name AND up.umi = w.at WHERE up.parent IS NULL),
sums AS (SELECT reference_name, final_umi, sum(n)::BIGINT AS final_umi_count FROM roots JOIN u USING (reference_name, umi) GROUP BY 1, 2),
ids AS (SELECT *, row_number() OVER (PARTITION BY reference_name ORDER BY final_umi_count DESC, final_umi) - 1 AS unique_id FROM sums)
SELECT reference_name, umi, n AS umi_count, final_umi, final_umi_count, unique_id FROM roots JOIN u USING (reference_name, umi) JOIN ids USING (reference_name, final_umi)"""


def umi_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Majority sequence of every UMI group."""
    d = T.tagged(spark, sf_dir).withColumn("unique_id", F.col("read_id").cast("long") % 50)
    return umi.consensus(d).select("reference_name", "unique_id", "consensus", "reads")


CONSENSUS = f"""WITH r AS (SELECT reference_name, read_id::BIGINT % 50 AS unique_id, query FROM ({T.TAGGED})),
v AS (SELECT reference_name, unique_id, p.p, substr(query, p.p::INT, 1) AS c, count(*) AS n FROM r, range(1, 25) p(p) WHERE p.p <= length(query) GROUP BY ALL),
b AS (SELECT reference_name, unique_id, p, arg_max(c, n * 10 - strpos('ATGC-N', c)) AS c FROM v GROUP BY ALL)
SELECT reference_name, unique_id, string_agg(c, '' ORDER BY p) AS consensus, any_value(reads) AS reads FROM b JOIN (SELECT reference_name, unique_id, count(*) AS reads FROM r GROUP BY 1, 2) USING (reference_name, unique_id) GROUP BY 1, 2"""


def _member(key: Column, copy: Column, seq: Column) -> Column:
    """A sequence with one changed base, elsewhere in every copy."""
    at = (F.lit(12) + (key * 7 + copy * 5) % 30).cast("int")
    return F.overlay(seq, F.translate(F.substring(seq, at, F.lit(1)), "ACGT", "CGTA"), at)


def molecule_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus of five copies of every read, insertions and deletions included; each copy has an error, one has no alignment and two bases too many."""
    d = T.reads(spark, sf_dir).withColumn("key", F.col("read_id").cast("long"))
    d = d.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(4))))
    wrong = _member(F.col("key"), F.col("copy"), F.col("query_seq"))
    odd = F.col("copy") == 3
    seq = F.when(odd, F.overlay(wrong, F.lit("GC"), F.lit(26), F.lit(0))).otherwise(wrong)
    d = d.withColumn("query_seq", seq).withColumn("cigar", F.when(~odd, F.col("cigar"))).withColumn("quals", F.lit(None).cast("array<int>"))
    return consensus.molecules(d, ["reference_name", "read_id"], rounds=2, margin=16)


MOLECULES = f"SELECT reference_name, read_id, 5::BIGINT AS reads, CASE WHEN cigar LIKE '3S%' THEN substr(query_seq, 4) ELSE query_seq END AS consensus FROM ({T.READS})"


def concatemer_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of reads that repeat every read five to seven times, with an error in each copy and a base missing in one; filtered by repeats and length."""
    d = T.reads(spark, sf_dir).select("read_id", "query_seq", F.col("read_id").cast("long").alias("key"))
    copy = lambda c: F.when(c == 1, F.overlay("query_seq", F.lit(""), (F.lit(22) + F.col("key") % 12).cast("int"), F.lit(1))).otherwise(_member(F.col("key"), c, F.col("query_seq")))
    whole = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("key") % 3 + 4).cast("int")), copy), "")
    found = consensus.concatemers(d.select("read_id", whole.alias("seq"), F.lit(None).cast("array<int>").alias("quals")))
    log = umi.rca_filter(found, T.references(spark), 7, 8)
    return found.join(log, "read_id").select("read_id", "repeats", "consensus", "original_read_length", "pass/fail")


CONCATEMERS = f"""SELECT read_id, repeats, query_seq AS consensus, (repeats * length(query_seq) - 1)::INTEGER AS original_read_length, CASE WHEN repeats BETWEEN 5 AND 6 THEN 'pass' ELSE 'fail' END AS "pass/fail"
FROM (SELECT read_id, query_seq, read_id::BIGINT % 3 + 5 AS repeats FROM ({T.READS}))"""


def rca_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concatemer reads by repeats and subread length."""
    d = T.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("r_"), k.cast("string"), F.lit("_9.5_600_"), (k % 9).cast("string"), F.lit("_"), (40 + k % 50).cast("string"))
    out = umi.rca_filter(d.select(name.alias("read_name")), T.references(spark), 4, 8)
    return out.select("read_id", "number_of_complete_repeats", "subread_length", "pass/fail")


RCA = """SELECT 'r_' || o_orderkey AS read_id, (o_orderkey % 9)::INT AS number_of_complete_repeats, (40 + o_orderkey % 50)::INT AS subread_length,
CASE WHEN o_orderkey % 9 BETWEEN 2 AND 6 AND 40 + o_orderkey % 50 BETWEEN 48 AND 72 THEN 'pass' ELSE 'fail' END AS "pass/fail" FROM orders"""


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest orders."""
    return top(T.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), F.col("o_orderkey"))


TOP_N = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"


def name_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of read names and descriptions."""
    k = F.col("o_orderkey").cast("string")
    d = T.table(spark, sf_dir, "orders").select(F.concat(F.lit("UMI-"), k, F.lit("|ref-refA|m_"), k, F.lit("_0")).alias("n"), F.concat(F.lit("id="), k, F.lit(" size=3")).alias("d"))
    p = S.parse_read_name(F.col("n"))
    return d.select(p["umi"].alias("umi"), p["reference_name"].alias("reference_name"), p["read"].alias("read"), F.element_at(S.description_fields(F.col("d")), "size").alias("size"))


NAMES = "SELECT o_orderkey::VARCHAR AS umi, 'refA' AS reference_name, 'm_' || o_orderkey AS read, '3' AS size FROM orders"

QUERIES = {
    f.__name__: (f, sql)
    for f, sql in (
        (barcode_identify, IDENTIFY), (barcode_exact, EXACT), (barcode_nearest, NEAREST), (barcode_group_match, GROUPED), (demux_stats, STATS), (demux_banish, BANISH),
        (demux_zero_fill, ZERO), (label_barcode_stats, LABELS), (top_references, TOP_REFS), (anti_missing, ANTI), (barcode_discovery, DISCOVERY), (coverage_bins, COVERAGE),
        (umi_extract, EXTRACT), (umi_extract_summary, SUMMARY), (umi_group_distribution, GROUP_SIZES), (umi_downsample, DOWNSAMPLE), (umi_ffill, FFILL),
        (umi_cluster, CLUSTERS), (umi_consensus, CONSENSUS), (molecule_consensus, MOLECULES), (concatemer_consensus, CONCATEMERS), (rca_filter, RCA), (top_n, TOP_N), (name_parsing, NAMES),
    )
}
