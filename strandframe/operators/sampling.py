"""Weighted samples without replacement in which every copy of a row draws on its own.

A row of weight w waits an exponential time of rate w; the rows that arrive
first are the sample. Of m equal rows the first arrives at rate m w, the next at
rate (m - 1) w after it, and so on: only as many arrivals as can be in the sample are
drawn for them, by jumps, however often the row occurs. Each task keeps the
first arrivals that it has seen, and these are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _uniform(text: Column) -> Column:
    """A number between 0 and 1 from a text, the same everywhere."""
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")
    return (drawn + 0.5) / float(1 << 48)


def weighted_sample(df: DataFrame, size: int, weight: str | None = None, seed: int = 0) -> DataFrame:
    """size rows without replacement, by weight if given (rows of null, zero or negative weight are never drawn).

    A draw is a digest of the seed, the row as text and the number of the copy, so it
    depends neither on partitions nor on row order. Nulls differ from empty texts.
    """
    names, plain = df.columns, [f"__c{k}" for k in range(len(df.columns))]
    rows = df.toDF(*plain)
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    rate = F.col(plain[names.index(weight)]).cast("double") if weight else F.lit(1.0)
    rows = rows.filter(rate > 0) if weight else rows
    text = F.concat_ws("|", F.lit(str(seed)), *map(shown, plain))
    counted = rows.groupBy(text.alias("__text")).agg(F.count("*").alias("__m"), F.first(F.struct(*plain)).alias("__row")).select("__text", "__m", "__row.*")
    text = F.col("__text")
    copies = F.sequence(F.lit(0).cast("long"), F.least(F.col("__m"), F.lit(max(size, 1)).cast("long")) - 1)
    # The first copy draws by the text alone. Without weights the order of the numbers themselves is kept.
    draw = lambda k: _uniform(F.when(k == 0, text).otherwise(F.concat_ws("|", text, k.cast("string"))))
    wait = (lambda k: -F.ln(draw(k))) if weight else (lambda k: -F.log1p(-draw(k)))
    start = F.array().cast("array<double>")
    arrivals = F.aggregate(copies, start, lambda done, k: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0.0)) + wait(k) / (rate * (F.col("__m") - k)))))
    drawn = counted.select(*plain, "__text", F.explode(arrivals).alias("__at"))
    return drawn.orderBy("__at", "__text").limit(size).select(*plain).toDF(*names)
