"""Time-series enrichment: counts to normalised log ratios, weighted slopes and replicate means.

Counts stay long: (group, replicate, sample_label, entity, timepoint, c). Time
points become columns only when a table is written (``wide``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.operators.common import keep_quantile, small

SAMPLE = ["group", "replicate", "sample_label"]


def timepoints(wide: DataFrame, times: list[str]) -> DataFrame:
    """Layout rows (sample_label, then one column per time of ``tag_group``) as long rows.

    Rows that repeat a label are its replicates in file order (column row).
    """
    rep = F.row_number().over(Window.partitionBy("sample_label").orderBy("row"))
    many = F.count("*").over(Window.partitionBy("sample_label")) > 1
    rows = wide.withColumn("group", F.col("sample_label")).withColumn("replicate", rep)
    rows = rows.withColumn("sample_label", F.when(many, F.concat("group", F.lit("-rep"), F.col("replicate").cast("string"))).otherwise(F.col("group")))
    long = rows.unpivot(["group", "replicate", "sample_label"], times, "timepoint", "tag_group").filter("tag_group is not null and tag_group != ''")
    tag = F.regexp_extract("tag_group", r"^(.*)_[^_]*$", 1)
    return long.withColumn("timepoint", F.col("timepoint").cast("double")).withColumn("tag", tag).withColumn("barcode_group", F.regexp_extract("tag_group", r"_([^_]*)$", 1))


def entity_counts(counts: DataFrame, layout: DataFrame, entity: str = "entity", count: str = "count", key: str = "tag_group", screen: bool = False) -> DataFrame:
    """Counts of entities per sample and time point; a tag and group may serve several samples.

    The grid is dense: an entity seen in a sample has a row for every time of it.
    """
    rows = counts.filter(~F.coalesce(F.col(entity).contains("fail"), F.lit(False))) if screen else counts
    summed = rows.groupBy(entity, key).agg(F.sum(count).alias("c"))
    seen = summed.join(small(layout), key).groupBy(*SAMPLE, F.col(entity).alias("entity"), "timepoint").agg(F.sum("c").alias("c"))
    return densify(seen, layout)


def densify(counts: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """A 0 where an entity of a sample is missing at one of the sample's times."""
    times = (layout if layout is not None else counts).select(*SAMPLE, "timepoint").distinct()
    grid = counts.select(*SAMPLE, "entity").distinct().join(small(times), SAMPLE)
    return grid.join(counts, [*SAMPLE, "entity", "timepoint"], "left").fillna({"c": 0})


def auto_reference(counts: DataFrame) -> DataFrame:
    """The one entity to normalise with, if any: (entity).

    Among entities present at every time of every sample, those with a first
    count from the lower quartile up, of these the ones with a last count up to
    the lower quartile, and of these the one with the largest last count; without
    any left, the largest last count of all present.
    """
    span = counts.agg(F.min("timepoint").alias("t0"), F.max("timepoint").alias("t1"))
    samples = counts.select(*SAMPLE).distinct().agg(F.count("*").alias("n"))
    every = counts.groupBy("entity").agg(F.min("c").alias("least"), F.countDistinct(F.struct(*SAMPLE)).alias("k"))
    common = every.crossJoin(F.broadcast(samples)).filter("least > 0 and k = n").select("entity")
    ends = counts.join(common, "entity").crossJoin(F.broadcast(span)).groupBy("entity").agg(
        F.avg(F.when(F.col("timepoint") == F.col("t0"), F.col("c"))).alias("first"), F.avg(F.when(F.col("timepoint") == F.col("t1"), F.col("c"))).alias("last")
    )
    late = keep_quantile(keep_quantile(ends, "first", 0.25), "last", 0.25, upper=False)
    ranked = late.withColumn("o", F.lit(0)).unionByName(ends.withColumn("o", F.lit(1)))
    return ranked.orderBy("o", F.desc("last"), "entity").limit(1).select("entity")


def normalise(counts: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Adds r, normalized and weight.

    r is the reference entity's count, or the sample's total without one or
    where the sample lacks it. normalized is ln((c + .5) / (r + .5)), null from
    the second time on at which the entity has no reads.
    """
    at = [*SAMPLE, "timepoint"]
    totals = counts.groupBy(*at).agg(F.sum("c").alias("total"))
    if reference is not None:
        own = counts.join(small(reference), "entity").groupBy(*at).agg(F.sum("c").alias("own"))
        r = F.coalesce("own", "total")
        totals = totals.join(own, at, "left")
    else:
        r = F.col("total")
    totals = totals.select(*at, r.cast("double").alias("r")).withColumn("r_share", F.col("r") / F.sum("r").over(Window.partitionBy(*SAMPLE)))
    rows = counts.join(small(totals), at)
    zeros = F.sum((F.col("c") == 0).cast("int")).over(Window.partitionBy(*SAMPLE, "entity").orderBy("timepoint").rowsBetween(Window.unboundedPreceding, 0))
    value = F.ln((F.col("c") + 0.5) / (F.col("r") + 0.5))
    weight = F.col("r_share") / (1 / (F.col("c") + 0.5) + 1 / (F.col("r") + 0.5))
    return rows.withColumn("normalized", F.when(zeros < 2, value)).withColumn("weight", weight).drop("r_share")


def regress(rows: DataFrame, weighted: bool = True) -> DataFrame:
    """enrichment_score and standard_error of every entity of a sample: one pass of sums.

    Time is scaled to the sample's last. Two points give their difference with a
    count-based error, fewer give nothing. Values below 1e-10 are 0.
    """
    by = [*SAMPLE, "entity"]
    last = rows.groupBy(*SAMPLE).agg(F.max("timepoint").alias("t_max"))
    p = rows.join(small(last), SAMPLE).filter("normalized is not null").withColumn("x", F.col("timepoint") / F.col("t_max"))
    p = p.withColumn("w", F.col("weight") if weighted else F.lit(1.0)).withColumn("y", F.col("normalized"))
    means = Window.partitionBy(*by)
    p = p.withColumn("dx", F.col("x") - F.sum(F.col("w") * F.col("x")).over(means) / F.sum("w").over(means))
    p = p.withColumn("dy", F.col("y") - F.sum(F.col("w") * F.col("y")).over(means) / F.sum("w").over(means))
    s = p.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(F.col("w") * F.col("dx") * F.col("dx")).alias("sxx"), F.sum(F.col("w") * F.col("dx") * F.col("dy")).alias("sxy"), F.sum(F.col("w") * F.col("dy") * F.col("dy")).alias("syy"),
        (F.max_by("y", "x") - F.min_by("y", "x")).alias("rise"), F.sqrt(F.sum(1 / (F.col("r") + 0.5) + 1 / (F.col("c") + 0.5))).alias("se2"),
    )
    slope = F.col("sxy") / F.col("sxx")
    wide = F.sqrt(F.greatest(F.lit(0.0), F.col("syy") - slope * F.col("sxy")) / (F.col("n") - 2) / F.col("sxx"))
    clean = lambda c: F.when(F.abs(c) < 1e-10, 0.0).otherwise(c)
    score = F.when(F.col("n") == 2, F.col("rise")).when(F.col("n") > 2, slope)
    error = F.when(F.col("n") == 2, F.col("se2")).when(F.col("n") > 2, wide)
    return s.select(*by, clean(score).alias("enrichment_score"), clean(error).alias("standard_error"))


def enrichment(counts: DataFrame, reference: DataFrame | None = None, weighted: bool = True) -> DataFrame:
    """Scores of entities with reads at more than one time."""
    seen = counts.groupBy(*SAMPLE, "entity").agg(F.sum((F.col("c") > 0).cast("int")).alias("k")).filter("k > 1").drop("k")
    scored = regress(normalise(counts, reference), weighted).filter("enrichment_score is not null")
    return scored.join(seen, [*SAMPLE, "entity"], "left_semi")


def mean_scores(scores: DataFrame, se_share: float = 0.0, t0: DataFrame | None = None, t0_share: float = 0.0, least: float | None = None, compat: bool = False) -> DataFrame:
    """Mean, deviation and number of replicates per group and entity.

    se_share drops that share of the largest errors of a replicate, t0_share
    that of the smallest first counts (t0: SAMPLE, entity, c). compat takes the deviation
    with the mean as one more value.
    """
    rows = scores
    if se_share:
        rows = keep_quantile(rows, "standard_error", 1 - se_share, upper=False, by=["group", "replicate"])
    if t0_share and t0 is not None:
        first = keep_quantile(t0, "c", t0_share, by=["group", "replicate"])
        rows = rows.join(first.select(*SAMPLE, "entity"), [*SAMPLE, "entity"], "left_semi")
    if least:
        rows = rows.filter(F.col("enrichment_score") >= least)
    mean, sd, n = F.avg("enrichment_score"), F.stddev_samp("enrichment_score"), F.count("enrichment_score")
    if compat:
        sd = F.sqrt(F.coalesce(F.var_pop("enrichment_score") * n / n, F.lit(0.0)))
    return rows.groupBy("group", "entity").agg(mean.alias("mean_enrichment_score"), sd.alias("std_enrichment_score"), n.alias("valid_replicates"))


def wide(rows: DataFrame, column: str, value: str, labels: list, by: list[str], suffix: str = "") -> DataFrame:
    """One column per label."""
    out = rows.groupBy(*by).pivot(column, labels).agg(F.first(value))
    return out.withColumnsRenamed({str(v): f"{v}{suffix}" for v in labels})


def merge_with_genotypes(ids: DataFrame, genotypes: DataFrame, scores: DataFrame, groups: list[str], drop_missing: bool = False) -> DataFrame:
    """Reads' genotypes with the scores of their label, one column per group."""
    table = wide(scores.withColumn("__k", F.split("entity", r"\|")), "group", "mean_enrichment_score", groups, ["__k"], "_score")
    if drop_missing:
        table = table.na.drop("any")
    table = table.withColumn("reference_name", F.get("__k", F.lit(0))).withColumn("label_barcodes", F.get("__k", F.lit(1))).drop("__k")
    # Of the reads of a genotype and label the one of the smallest id stands for all.
    joined = ids.groupBy("genotype_ID", "reference_name", "label_barcodes").agg(F.min("seq_ID").alias("seq_ID")).join(genotypes, ["genotype_ID", "reference_name"], "left")
    return joined.join(table, ["reference_name", "label_barcodes"], "left")


def replicate_agreement(scores: DataFrame) -> DataFrame:
    """(group, a, b, n, slope, intercept, r2, r2_identity) of every two replicates."""
    a = scores.select("group", "entity", F.col("replicate").alias("a"), F.col("enrichment_score").alias("x"))
    b = scores.select("group", "entity", F.col("replicate").alias("b"), F.col("enrichment_score").alias("y"))
    both = a.join(b, ["group", "entity"]).filter("a < b")
    sums = both.groupBy("group", "a", "b").agg(
        F.count("*").alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.regr_r2("y", "x").alias("r2"),
        (1 - F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y"))) / (F.var_pop("x") * F.count("*"))).alias("r2_identity"),
    )
    return sums
