"""Pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.operators.quantiles import quantile
from strandframe.scratch import Scratch

#: Bytes, by the optimizer's estimate, up to which a lookup side is broadcast.
SMALL = 64 << 20


def small(df: DataFrame, size: int = SMALL) -> DataFrame:
    """df with a broadcast hint if its plan is known to give no more than so many bytes.

    The optimizer knows no size of rows that the driver holds. Left to itself it shuffles both sides by
    the key, and a table of few keys (references) then draws all reads into as many tasks. Such
    sides are written once, and judged by their files; for others nothing is computed.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if int(str(plan.stats().sizeInBytes())) > size and not df.isStreaming:
        leaves = plan.collectLeaves()
        if any(leaves.apply(k).nodeName() == "LogicalRDD" for k in range(leaves.size())):
            df = Scratch(df.sparkSession, "lookup").save(df)
            plan = df._jdf.queryExecution().optimizedPlan()
    return F.broadcast(df) if int(str(plan.stats().sizeInBytes())) <= size else df


def distribution(df: DataFrame, x: str, by: list[str] | None = None, weight: str | None = None, trim: bool = True) -> DataFrame:
    """Dense histogram of the non-negative integer x per group: total, proportion and cumulative share.

    Values that do not occur count 0, up to the largest that does; without trim
    rows of weight 0 extend the range too.
    """
    by = by or []
    n = F.sum(weight) if weight else F.count("*")
    seen = df.filter(F.col(x).isNotNull()).groupBy(*by, F.col(x).cast("int").alias("x")).agg(n.cast("long").alias("total"))
    if trim:
        seen = seen.filter("total > 0")
    spine = seen.groupBy(*by).agg(F.max("x").alias("top")).filter("top is not null").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("top")))).drop("top")
    dense = spine.join(seen, [*by, "x"], "left").fillna({"total": 0})
    whole = Window.partitionBy(*by)
    running = whole.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("total").over(whole)
    return dense.select(
        *by, "x", "total", (F.col("total") / share).alias("proportion"), (F.sum("total").over(running) / share).alias("cumulative")
    )


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ranked(df: DataFrame, by: list[str], coarse: list[Column], fine: list[Column], name: str = "rank") -> DataFrame:
    """df with the 1-based place of every row in its group, by the coarse keys, then the fine ones.

    Coarse keys (ascending, not null) cut a group into runs whose
    sizes are summed first; rows are numbered inside a run. So a group that
    holds most rows is spread over tasks, and no task sorts a whole group.
    """
    keys = [f"__k{i}" for i in range(len(coarse))]
    rows = df.withColumns(dict(zip(keys, coarse, strict=True)))
    sizes = rows.groupBy(*by, *keys).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, *keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(*by, *keys).orderBy(*fine))
    return rows.join(starts, [*by, *keys]).withColumn(name, (F.col("__start") + inside).cast("long")).drop(*keys, "__start")


def keep_quantile(df: DataFrame, col: str, q: float, upper: bool = True, by: list[str] | None = None) -> DataFrame:
    """Rows at or above (or below) a linear-interpolated quantile of col, per group if given."""
    edge = quantile(df, col, q, by, "__edge")
    joined = df.join(edge, by) if by else df.crossJoin(F.broadcast(edge))
    test = F.col(col) >= F.col("__edge") if upper else F.col(col) <= F.col("__edge")
    return joined.filter(test).drop("__edge")


def label_union(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL by name with the origin as a column."""
    out = None
    for name, df in frames.items():
        df = df.withColumn(label, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return expected.join(found, key, "left_anti")


def runs(df: DataFrame, by: list[str], pos: str) -> DataFrame:
    """Gaps and islands: runs of consecutive integers per group as (by, first, length)."""
    w = Window.partitionBy(*by).orderBy(pos)
    return df.withColumn("__g", F.col(pos) - F.row_number().over(w)).groupBy(*by, "__g").agg(F.min(pos).alias("first"), F.count("*").alias("length")).drop("__g")


def fill_both_ways(df: DataFrame, by: list[str], order: str, col: str) -> DataFrame:
    """Nulls of col from the previous, else the next value of the same group."""
    w = Window.partitionBy(*by).orderBy(order)
    back = F.last(col, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(col, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(col, F.coalesce(back, ahead))
