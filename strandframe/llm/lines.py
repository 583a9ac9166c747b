"""Cross-site boilerplate lines: distinct-site spread by HyperLogLog, exact near the threshold.

A line is the text between newlines without white space around it; empty lines
are nobody's boilerplate. The spread of a line is the number of different sites
whose documents hold it. Lines with a spread of ``sites`` or more are boilerplate
and are removed from every document.

Lines are reduced to 64-bit hashes. Every line gets an HLL sketch of its sites,
built where its rows are read and merged by aggregation, with the number of its
documents beside it. Estimates that differ from the threshold by less than
``margin`` of it are replaced by exact distinct counts, for these lines alone; a
line in fewer documents than ``sites`` is out without an estimate. The texts are
read twice: for the lines, which are written once as hashes, and for the removal.
SQL functions only.

Outputs are named ``__lines``, ``__removed`` and ``__clean``; an input column of such a
name is kept with ``_in`` appended. Defined cases: a null text stays null with no
lines, an empty one empty. A null site counts for no spread, but its documents are
cleaned. Repeated rows and null ids are cleaned row by row, and an empty table
gives an empty one. All columns are kept as they are. Texts are worked off whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import all_of, col, make_room, prefix
from strandframe.llm._store import Scratch

SITES = 5
MARGIN = 0.25


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(line, r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")))


def _keys(text: Column) -> Column:
    """Hash of every line of a text; null for blank lines."""
    return F.transform(F.split(text, "\n"), lambda x: F.when(_filled(x), line_key(x)))


def _filled(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_sites(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(row, key, site): the different lines of every row; row names it by a hash of id and text."""
    keys = F.explode(F.array_distinct(_keys(col(text_col))))
    return docs.select(_row(id_col, text_col).alias("row"), keys.alias("key"), col(site_col).cast("string").alias("site")).filter("key is not null")


def _row(id_col: str, text_col: str) -> Column:
    return F.xxhash64(col(id_col), col(text_col))


def boilerplate(held: DataFrame, scratch: Scratch, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """(key, spread) of the lines (key, site) found on sites different sites or more."""
    per = held.groupBy("key").agg(F.count("site").alias("c"), F.hll_sketch_agg("site", F.lit(12)).alias("sketch"))
    sketched = per.filter(F.col("c") >= sites).select("key", F.hll_sketch_estimate("sketch").alias("estimate"))
    # Written, so that the few lines left are known to be few when they are joined to all rows of a line.
    sketched = scratch.save(sketched.filter(F.col("estimate") > sites * (1 - margin)), "estimates")
    sure = sketched.filter(F.col("estimate") >= sites * (1 + margin)).select("key", F.col("estimate").alias("spread"))
    close = sketched.filter(F.col("estimate") < sites * (1 + margin)).select("key")
    pairs = held.filter("site is not null").join(close, "key", "left_semi").select("key", "site").distinct()
    return sure.unionByName(pairs.groupBy("key").agg(F.count("*").alias("spread")).filter(F.col("spread") >= sites))


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    sites: int = SITES, margin: float = MARGIN,
) -> DataFrame:
    """docs with __lines, __removed (numbers of lines) and __clean (the text left)."""
    docs = make_room(docs, ["__lines", "__removed", "__clean"], [id_col, text_col, site_col])
    p, names, scratch = prefix(docs), docs.columns, Scratch(docs.sparkSession, "lines")
    held = scratch.save(line_sites(docs, id_col, text_col, site_col), "lines")
    found = scratch.save(boilerplate(held, scratch, sites, margin).select("key"), "boilerplate")
    bad = held.join(found, "key", "left_semi").groupBy(F.col("row").alias(f"{p}of")).agg(F.collect_set("key").alias(f"{p}bad"))
    joined = docs.withColumn(f"{p}row", _row(id_col, text_col)).join(bad, F.col(f"{p}row") == F.col(f"{p}of"), "left")
    lines, worse = F.split(col(text_col), "\n"), F.col(f"{p}bad").isNotNull()
    left = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(f"{p}bad", line_key(x)) & _filled(x), F.lit(False)))
    out = joined.withColumn(f"{p}left", F.when(worse, left).otherwise(lines))
    count = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return out.select(
        *all_of(names), F.when(col(text_col).isNull(), F.lit(0)).otherwise(count).cast("long").alias("__lines"),
        F.when(worse, count - F.size(f"{p}left")).otherwise(F.lit(0)).cast("long").alias("__removed"),
        F.when(worse, F.array_join(f"{p}left", "\n")).otherwise(col(text_col)).alias("__clean"),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, source, i, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL)),
bad AS (SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {sites}),
per AS (
  SELECT doc_id, count(*) AS n_lines, count(bad.bare) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE bad.bare IS NULL) AS kept
  FROM lines LEFT JOIN bad USING (bare) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(kept, ''))::BIGINT END AS kept_chars,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(kept, '')) END AS kept_md5
FROM documents d LEFT JOIN per USING (doc_id)
"""
