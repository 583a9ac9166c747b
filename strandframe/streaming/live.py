"""Streaming forms of the per-read steps: an extension, as the batch engine has no streams.

Per-read steps keep no state; counts per file are an update-mode aggregation.
The barcode dictionary is an array literal of bounded size, searched in place,
so the nearest barcode needs no stateful join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandframe.functions import seq as S
from strandframe.operators.demux import Barcode

#: Barcodes that fit into a literal.
MOST_WORDS = 10_000


def nearest_word(query: Column, words: list[tuple[str, str]], most: int) -> Column:
    """Name of the nearest of (name, seq) within most mismatches, the first of equals."""
    if len(words) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} barcodes; use the batch operator")
    table = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(s).alias("seq"), F.lit(k).alias("k")) for k, (n, s) in enumerate(words)))
    scored = F.transform(table, lambda w: F.struct(S.hamming(query, w["seq"]).alias("d"), w["k"].alias("k"), w["name"].alias("name")))
    best = F.array_min(F.filter(scored, lambda x: x["d"] <= most))
    return F.when(query.isNotNull(), best["name"])


def identify(reads: DataFrame, types: list[Barcode], words: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """reads (gapped_ref, query), batch or stream, with a name per barcode type."""
    out = reads
    for b in types:
        out = out.withColumn("__at", S.find_context(F.col("gapped_ref"), b.context))
        seq = F.expr("substring(query, __at.start + 1, __at.stop - __at.start)")
        out = out.withColumn(b.name, F.coalesce(nearest_word(seq, words[b.name], b.hamming_distance), F.lit("fail"))).drop("__at")
    return out


def running_counts(reads: DataFrame, by: list[str], time: str | None = None, late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Reads per key, in windows with a watermark where there is an event time."""
    if time:
        return reads.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))
    return reads.groupBy(*by).agg(F.count("*").alias("n"))


def run_to_table(df: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    """Work off what is there and stop; the result is the in-memory table name."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
