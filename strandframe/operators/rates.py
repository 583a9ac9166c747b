"""Mutation rates over time and mutation spectra, from mutation statistics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.operators.stats import CHANGES


def base_factors(ref: str) -> dict[str, float]:
    """Weights that make a reference's bases equally frequent."""
    ref = ref.upper()
    return {b: len(ref) / (4 * ref.count(b)) for b in "ATGC" if ref.count(b)}


def per_base(stats: DataFrame, ref: str) -> DataFrame:
    """Long table: id columns, mut_type, value; mutations per base normalised to equal base shares.

    stats has total_seqs, the twelve changes and total_insertion_length,
    total_deletion_length; the type all is the sum of the twelve.
    """
    factor, bases = base_factors(ref), F.col("total_seqs") * len(ref)
    value = {c: F.lit(factor.get(c[0], 0.0)) * F.col(f"`{c}`") / bases for c in CHANGES}
    total = sum(list(value.values())[1:], value[CHANGES[0]])
    indel = {c: F.col(c) / bases for c in ("total_insertion_length", "total_deletion_length") if c in stats.columns}
    items = {"all": total, **value, **indel}
    ids = [c for c in stats.columns if c not in (*CHANGES, "total_seqs", "total_insertion_length", "total_deletion_length")]
    return stats.select(*ids, F.explode(F.array(*(F.struct(F.lit(k).alias("mut_type"), v.alias("value")) for k, v in items.items()))).alias("m")).select(*ids, "m.*")


def rates(values: DataFrame, by: tuple[str, ...] = ("sample_label", "replicate", "mut_type"), background: DataFrame | None = None) -> DataFrame:
    """Least-squares slope of value on timepoint per group of two points or more.

    background: tag, mut_type, base values that are subtracted first.
    """
    if background is not None:
        values = values.join(background.select("tag", "mut_type", F.col("value").alias("__b")), ["tag", "mut_type"], "left")
        values = values.withColumn("value", F.col("value") - F.coalesce("__b", F.lit(0.0))).drop("__b")
    y, x = F.col("value"), F.col("timepoint")
    fit = values.groupBy(*by).agg(
        F.count("*").alias("n"), F.regr_slope(y, x).alias("rate"), F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("r_value"),
        F.regr_sxx(y, x).alias("__sxx"), F.regr_syy(y, x).alias("__syy"), F.regr_sxy(y, x).alias("__sxy"),
    ).filter("n >= 2")
    rest = F.greatest(F.lit(0.0), F.col("__syy") - F.col("__sxy") * F.col("__sxy") / F.col("__sxx"))
    error = F.when(F.col("n") > 2, F.sqrt(rest / (F.col("n") - 2) / F.col("__sxx"))).otherwise(F.lit(0.0))
    fit = fit.withColumn("std_err", error)
    kind = F.col("mut_type")
    fit = fit.withColumn("wt_nt", F.when(kind.contains("->"), F.substring(kind, 1, 1))).withColumn("mut_nt", F.when(kind.contains("->"), F.substring(kind, 4, 1)))
    return fit.drop("__sxx", "__syy", "__sxy")


def with_p_value(fits: DataFrame) -> DataFrame:
    """Adds the two-sided p-value of r_value with n - 2 degrees of freedom."""

    @F.pandas_udf("double")
    def p_value(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([student_p(a, int(b)) for a, b in zip(r, n, strict=True)])

    return fits.withColumn("p_value", p_value("r_value", "n"))


def student_p(r: float | None, n: int) -> float | None:
    if r is None or r != r:
        return None
    if n <= 2:
        return 1.0
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    return _beta_share(df / 2, 0.5, 1 - r * r)


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d or 1e-300)
    out = d
    for m in range(1, 400):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + k * d) or 1e-300)
            c = (1 + k / c) or 1e-300
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * out


def rate_summary(fits: DataFrame) -> DataFrame:
    """Mean, deviation and quartiles over replicates; means and medians that are nothing are null."""
    floor = F.greatest(F.col("rate"), F.lit(1e-10))
    out = fits.withColumn("rate", floor).groupBy("sample_label", "mut_type").agg(
        F.count("*").alias("n"), F.avg("rate").alias("mean"), F.stddev_samp("rate").alias("std"), F.min("rate").alias("min"),
        F.percentile("rate", F.lit(0.25)).alias("q25"), F.percentile("rate", F.lit(0.5)).alias("median"), F.percentile("rate", F.lit(0.75)).alias("q75"), F.max("rate").alias("max"),
    )
    none = lambda c: F.when(F.col(c) > 1e-8, F.col(c))
    return out.withColumn("mean", none("mean")).withColumn("median", none("median"))


def spectrum(stats: DataFrame, ref: str, background: DataFrame | None = None) -> DataFrame:
    """id columns, wt_nt, mut_nt, share: the twelve changes, normalised to bases and to sum 1.

    background: one row of statistics, subtracted per sequence; what is less than nothing is 0.
    Several rows are an error, none subtracts nothing.
    """
    factor = base_factors(ref)
    ids = [c for c in stats.columns if c not in (*CHANGES, "total_seqs", "total_NT_mutations")]
    rows = stats
    if background is not None:
        one = F.assert_true(F.count("*") <= 1, "the background has several rows").alias("__one")
        means = (F.coalesce(F.max(F.col(f"`{c}`") / F.col("total_seqs")), F.lit(0.0)).alias(f"__{c}") for c in CHANGES)
        rows = rows.crossJoin(F.broadcast(background.agg(*means, one))).filter("__one is null")

    def value(c: str):
        n = F.col(f"`{c}`")
        own = F.greatest(F.lit(0.0), n / F.col("total_seqs") - F.col(f"`__{c}`")) if background is not None else n / F.nullif(F.col("total_NT_mutations"), F.lit(0))
        return F.coalesce(F.lit(factor.get(c[0], 0.0)) * own, F.lit(0.0))

    long = rows.withColumn("__m", F.array(*(F.struct(F.lit(c[0]).alias("wt_nt"), F.lit(c[-1]).alias("mut_nt"), value(c).alias("v")) for c in CHANGES)))
    total = F.nullif(F.aggregate("__m", F.lit(0.0), lambda a, x: a + x["v"]), F.lit(0.0))
    return long.withColumn("__t", total).select(*ids, "__t", F.explode("__m").alias("m")).select(*ids, "m.wt_nt", "m.mut_nt", (F.col("m.v") / F.col("__t")).alias("share"))
