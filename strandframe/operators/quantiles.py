"""Exact quantiles of groups of any size: a sketch brackets the edge, exact counts find it inside the bracket.

A quantile sketch of every group is merged by aggregation; it names two values
between which the quantile must lie. One more pass counts the rows below the
bracket and each value inside it, about ``4 / ACCURACY`` of the rows. So no task holds
the distinct values of a group, only its sketch and its bracket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranks of the sketch are right to within rows / ACCURACY; the bracket is twice as wide on both sides.
ACCURACY = 10_000


def quantile(df: DataFrame, col: str, q: float, by: list[str] | None = None, name: str = "quantile", accuracy: int = ACCURACY) -> DataFrame:
    """(by, name): the linear-interpolated quantile q of col in every group that has values; nulls do not count.

    The same number that ``percentile`` gives. Groups whose sketch missed the rank, which its
    guarantee excludes, would be counted in full.
    """
    by = by or []
    if not 0 <= q <= 1:
        raise ValueError("a quantile is between 0 and 1")
    keys = [f"__g{k}" for k in range(len(by))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True)), F.col(col).cast("double").alias("__x")).filter("__x is not null")
    ends = F.array(F.lit(max(0.0, q - 2 / accuracy)), F.lit(min(1.0, q + 2 / accuracy)))
    sketch = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx("__x", ends, accuracy).alias("__ends"))
    # Groups are matched by what their keys are as a whole, nulls included.
    group = F.struct(*keys) if keys else F.lit(1)
    sketch = sketch.select(group.alias("__group"), "__n", F.col("__ends")[0].alias("__lo"), F.col("__ends")[1].alias("__hi"))
    rows = rows.select(group.alias("__of"), "__x")
    met = rows.join(sketch, F.col("__of").eqNullSafe(F.col("__group")))
    part = F.when(F.col("__x") < F.col("__lo"), 0).when(F.col("__x") <= F.col("__hi"), 1).otherwise(2)
    counts = met.select("__group", "__n", part.alias("__part"), F.when(part == 1, F.col("__x")).alias("__v")).groupBy("__group", "__n", "__part", "__v").agg(F.count("*").alias("__c"))
    running = Window.partitionBy("__group").orderBy("__part", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = (F.col("__n") - 1) * F.lit(q)
    low, high = F.floor(at), F.ceil(at)
    ranked = counts.withColumn("__upto", F.sum("__c").over(running))
    value = lambda rank: F.min(F.when((F.col("__part") == 1) & (F.col("__upto") > rank), F.col("__v")))
    below = F.coalesce(F.max(F.when(F.col("__part") == 0, F.col("__upto"))), F.lit(0))
    inside = F.coalesce(F.max(F.when(F.col("__part") == 1, F.col("__upto"))), F.lit(0))
    found = ranked.groupBy("__group", "__n").agg(value(low).alias("__a"), value(high).alias("__b"), below.alias("__below"), inside.alias("__inside"))
    held = (F.col("__below") <= low) & (F.col("__inside") > high)
    between = F.when((low == high) | (F.col("__a") == F.col("__b")), F.col("__a")).otherwise((high - at) * F.col("__a") + (at - low) * F.col("__b"))
    edges = found.filter(held).select("__group", between.alias(name))
    missed = found.filter(~held).select("__group")
    again = rows.join(missed, F.col("__of").eqNullSafe(F.col("__group"))).groupBy("__group").agg(F.percentile("__x", F.lit(q)).alias(name))
    out = edges.unionByName(again)
    return out.select(*(F.col("__group")[k].alias(c) for c, k in zip(by, keys, strict=True)), name)
