"""Barcode identification, demultiplexing and its statistics.

A barcode type is a ``Barcode``; its dictionary is a DataFrame (barcode_type,
seq, name). Reads get one name per type, ``fail`` where none is found.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.functions import seq as S
from strandframe.operators.common import ranked, small

FAILS = ("context_not_present_in_reference_sequence", "barcode_not_in_fasta", "low_confidence_barcode_identification")


@dataclass(frozen=True)
class Barcode:
    name: str
    context: str
    reverse_complement: bool = False
    label_only: bool = False
    hamming_distance: int = 0


def dictionary(entries: DataFrame, types: list[Barcode]) -> DataFrame:
    """Barcode sequences turned where the type asks for it; of equal ones the last stays.

    entries: barcode_type, ord (place in its file), name, seq.
    """
    turned = [b.name for b in types if b.reverse_complement]
    seq = F.when(F.col("barcode_type").isin(turned), S.reverse_complement(F.col("seq"))).otherwise(F.upper("seq"))
    rows = entries.withColumn("seq", seq).groupBy("barcode_type", "seq").agg(F.max_by("name", "ord").alias("name"), F.min("ord").alias("ord"))
    return rows


def nearest(queries: DataFrame, words: DataFrame, most: int, by: str = "barcode_type") -> DataFrame:
    """(by, seq, name, distance): the nearest word within most mismatches, the first of equals.

    Words and queries of a type share a length. Both are cut into most + 1
    segments; words within most mismatches agree on one, so an equi-join on
    segments finds them all without comparing every pair.
    """
    def cut(df: DataFrame, *keep: str) -> DataFrame:
        step = F.greatest(F.lit(1), F.floor(F.length("seq") / (most + 1))).cast("int")
        piece = lambda k: F.struct(F.lit(k).alias("k"), F.substring(F.col("seq"), F.lit(k) * step + 1, F.when(F.lit(k == most), F.length("seq")).otherwise(step)).alias("part"))
        return df.select(by, "seq", *keep, F.explode(F.array(*(piece(k) for k in range(most + 1)))).alias("p")).select(by, "seq", *keep, F.col("p.k").alias("k"), F.col("p.part").alias("part"))

    left = cut(queries.select(by, "seq").distinct())
    right = cut(words, "name", "ord").withColumnRenamed("seq", "word")
    met = left.join(small(right), [by, "k", "part"]).filter(F.length("seq") == F.length("word")).select(by, "seq", "word", "name", "ord").distinct()
    scored = met.withColumn("distance", S.hamming(F.col("seq"), F.col("word"))).filter(F.col("distance") <= most)
    return scored.groupBy(by, "seq").agg(F.min(F.struct("distance", "ord", "name")).alias("m")).select(by, "seq", "m.name", "m.distance")


def identify(reads: DataFrame, words: DataFrame, types: list[Barcode]) -> DataFrame:
    """reads (gapped_ref, query: aligned) with, per type, its name and its four counters."""
    out = reads
    for b in types:
        spot = S.find_context(F.col("gapped_ref"), b.context)
        out = out.withColumn("__at", spot).withColumn("__seq", F.expr("substring(query, __at.start + 1, __at.stop - __at.start)"))
        own = words.filter(F.col("barcode_type") == b.name)
        exact = small(own.select(F.col("seq").alias("__seq"), F.col("name").alias("__exact")))
        out = out.join(exact, "__seq", "left").withColumn("__near", F.lit(None).cast("string"))
        if b.hamming_distance:
            open_ = out.filter("__exact is null and __seq is not null").select(F.lit(b.name).alias("barcode_type"), F.col("__seq").alias("seq")).distinct()
            near = nearest(open_, own, b.hamming_distance).select(F.col("seq").alias("__seq"), F.col("name").alias("__found"))
            out = out.drop("__near").join(near, "__seq", "left").withColumnRenamed("__found", "__near").withColumn("__near", F.when(F.col("__exact").isNull(), F.col("__near")))
        found = F.coalesce("__exact", "__near")
        out = out.withColumn(b.name, F.coalesce(found, F.lit("fail")))
        out = out.withColumn(f"{b.name}:not_exact_match", F.col("__near").isNotNull().cast("long"))
        tests = (F.col("__at.reason") == "context_not_present", F.col("__at.reason").isNull() & found.isNull(), F.col("__at.reason") == "low_confidence")
        for fail, test in zip(FAILS, tests, strict=True):
            out = out.withColumn(f"{b.name}_failed:{fail}", F.coalesce(test, F.lit(False)).cast("long"))
        out = out.drop("__at", "__seq", "__exact", "__near")
    return out


def match_group(reads: DataFrame, groups: DataFrame, types: list[str], name: str) -> DataFrame:
    """reads with the first group, in file order, whose members all agree; members left out match anything.

    groups: group_order, group, members (map type to barcode). Combinations are
    matched once each; a read with a failed barcode of the types has no group.
    """
    if not types:
        return reads.withColumn(name, F.lit(None).cast("string"))
    combos = reads.select(*types).distinct()
    given = F.create_map(*(x for t in types for x in (F.lit(t), F.col(t))))
    agree = F.forall(F.filter(F.map_keys("members"), lambda k: F.array_contains(F.array(*map(F.lit, types)), k)), lambda k: F.element_at("members", k) == F.element_at("__given", k))
    hits = combos.withColumn("__given", given).join(small(groups), agree & ~F.exists(F.map_values("__given"), lambda v: v == "fail"))
    picked = hits.groupBy(*types).agg(F.min_by("group", "group_order").alias(name))
    return reads.join(picked, types, "left")


def demultiplex(reads: DataFrame, types: list[Barcode], partition_groups: DataFrame | None = None, label_groups: DataFrame | None = None) -> DataFrame:
    """Identified reads with output_file_barcodes, named_by_group and label_barcodes."""
    part, label = [b.name for b in types if not b.label_only], [b.name for b in types if b.label_only]
    out = match_group(reads, partition_groups, part, "__p") if partition_groups is not None else reads.withColumn("__p", F.lit(None).cast("string"))
    out = match_group(out, label_groups, label, "__l") if label_groups is not None else out.withColumn("__l", F.lit(None).cast("string"))
    joined = lambda names, sep: F.concat_ws(sep, *(F.col(n) for n in names)) if names else None
    file = F.coalesce("__p", joined(part, "-")) if part else F.lit("all")
    mark = F.coalesce("__l", joined(label, "-")) if label else F.lit("none")
    tag = F.coalesce("__l", joined(label, "_")) if label else F.lit("none")
    out = out.withColumn("output_file_barcodes", file).withColumn("named_by_group", F.col("__p").isNotNull())
    return out.withColumn("label_barcodes", mark).withColumn("bc", tag).drop("__p", "__l")


def statistics(reads: DataFrame, types: list[Barcode], partition_groups: DataFrame | None = None) -> DataFrame:
    """Counts per tag, file, group flag, reference, labels and barcodes, with failure counters.

    Expected groups without reads get a row of zeros.
    """
    names = [b.name for b in types]
    counters = [f"{n}{s}" for n in names for s in (":not_exact_match", *(f"_failed:{f}" for f in FAILS))]
    by = ["tag", "output_file_barcodes", "named_by_group", "reference_name", *names, "label_barcodes"]
    counted = reads.groupBy(*by).agg(F.count("*").alias("barcodes_count"), *(F.sum(F.col(f"`{c}`")).alias(c) for c in counters))
    file = Window.partitionBy("tag", "output_file_barcodes")
    out = counted.withColumn("demuxed_count", F.sum("barcodes_count").over(file))
    if partition_groups is not None:
        seen = out.filter("named_by_group").select(F.col("output_file_barcodes").alias("group"), "tag").distinct()
        # Every group with every tag, however many: the groups come from a definition file.
        wanted = out.select("tag").distinct().crossJoin(small(partition_groups.select("group").distinct()))
        empty = wanted.join(seen, ["group", "tag"], "left_anti").select(
            "tag", F.col("group").alias("output_file_barcodes"), F.lit(True).alias("named_by_group"), F.lit("n/a").alias("reference_name"),
            *(F.lit("n/a").alias(n) for n in names), F.lit("none").alias("label_barcodes"), F.lit(0).cast("long").alias("barcodes_count"),
            *(F.lit(0).cast("long").alias(c) for c in counters), F.lit(0).cast("long").alias("demuxed_count"),
        )
        out = out.unionByName(empty)
    ordered = ["tag", "output_file_barcodes", "named_by_group", "reference_name", *names, "demuxed_count", "label_barcodes", "barcodes_count", *counters]
    return out.select(*(F.col(f"`{c}`") for c in ordered))


def banished(stats: DataFrame, types: list[Barcode], threshold: float = 0.0, screen_failures: bool = False, screen_no_group: bool = False) -> DataFrame:
    """Files that are left out of further analysis."""
    total = Window.partitionBy("tag")
    least = F.lit(float(threshold)) if threshold > 1 else F.lit(float(threshold)) * F.sum("barcodes_count").over(total)
    bad = F.col("demuxed_count") < least
    if screen_failures:
        for b in types:
            whole = F.col("barcodes_count") == F.col("demuxed_count") if b.label_only else F.lit(True)
            bad = bad | ((F.col(b.name) == "fail") & whole)
    if screen_no_group:
        bad = bad | ~F.col("named_by_group")
    rows = stats.withColumn("__bad", bad & (F.col("demuxed_count") > 0))
    return rows.groupBy("tag", "output_file_barcodes").agg(F.bool_or("__bad").alias("banished")).filter("banished").select("tag", "output_file_barcodes")


def top_references(reads: DataFrame, n: int) -> DataFrame:
    """Reads of the n most frequent references; ties by name."""
    best = reads.groupBy("reference_name").count().orderBy(F.desc("count"), "reference_name").limit(n)
    return reads.join(F.broadcast(best.select("reference_name")), "reference_name", "left_semi")


def discover(found: DataFrame, n: int | None = None, min_distance: int = 0) -> DataFrame:
    """Barcodes of reads as new dictionaries: most frequent first, named bc1, bc2, ...

    found: barcode_type, seq. Sequences with N are left out. With min_distance,
    barcodes nearer than that to a more frequent one are dropped.
    """
    counted = found.filter(~F.col("seq").contains("N")).groupBy("barcode_type", "seq").agg(F.count("*").alias("count"))
    if min_distance > 1:
        from strandframe.operators.umi import cluster

        counted = cluster(counted.select(F.col("barcode_type").alias("reference_name"), F.col("seq").alias("umi"), F.col("count").alias("umi_count")), min_distance - 1)
        counted = counted.filter("umi = final_umi").select(F.col("reference_name").alias("barcode_type"), F.col("umi").alias("seq"), F.col("final_umi_count").alias("count"))
    out = ranked(counted, ["barcode_type"], [-F.col("count"), F.substring("seq", 1, 4)], [F.col("seq")], "ord").withColumn("name", F.concat(F.lit("bc"), F.col("ord").cast("string")))
    return out.filter(F.col("ord") <= n) if n else out


def label_statistics(stats: DataFrame, types: list[Barcode]) -> DataFrame:
    """Per file: different label combinations, reads, reads with a failed label, and the rest."""
    label = [b.name for b in types if b.label_only]
    failed = reduce(lambda a, b: a | b, [F.col(n) == "fail" for n in label], F.lit(False))
    out = stats.filter("barcodes_count > 0").groupBy("tag", "output_file_barcodes").agg(
        F.countDistinct("label_barcodes").alias("unique_labels"), F.sum("barcodes_count").alias("total"), F.sum(F.when(failed, F.col("barcodes_count")).otherwise(0)).alias("failed")
    )
    return out.withColumn("success", F.col("total") - F.col("failed"))


def coverage_bins(stats: DataFrame, column: str = "barcodes_count") -> DataFrame:
    """References by order of magnitude of their reads."""
    per = stats.groupBy("reference_name").agg(F.sum(column).alias("n")).filter("n > 0")
    return per.groupBy((F.length(F.col("n").cast("string")) - 1).alias("log10_bin")).agg(F.count("*").alias("references"))
