"""Distances of all pairs of genotypes as histograms of pairs of blocks.

Genotypes are dealt into blocks of about ``BLOCK``; a task takes two blocks and
returns the histogram of the distances between their members, which adds up with
the others. So what is shuffled grows with the number of blocks squared, and no row
is made for a pair of genotypes, however many positions they share.

Two genotypes with n and m changed positions, s of them shared and e of these with
the same letter, differ in n + m - s - e positions. s and e of all pairs of two
blocks are products of two incidence matrices, over what occurs in both blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandframe.operators.common import distribution
from strandframe.scratch import Scratch

#: Genotypes of a block, about; columns of a matrix that are multiplied at once.
BLOCK, COLUMNS = 1024, 4096


def _shared(first: list[list], second: list[list]) -> np.ndarray:
    """How many items each list of the first side shares with each of the second; no list repeats an item."""
    both = {x for row in first for x in row} & {x for row in second for x in row}
    place = {x: k for k, x in enumerate(both)}
    out = np.zeros((len(first), len(second)), np.float32)
    sides = []
    for rows in (first, second):
        hits = [(k, place[x]) for k, row in enumerate(rows) for x in row if x in place]
        sides.append(np.array(hits, np.int64).reshape(-1, 2))
    for lo in range(0, len(both), COLUMNS):
        planes = []
        for hits, rows in zip(sides, (first, second), strict=True):
            part = hits[(hits[:, 1] >= lo) & (hits[:, 1] < lo + COLUMNS)]
            plane = np.zeros((len(rows), min(COLUMNS, len(both) - lo)), np.float32)
            plane[part[:, 0], part[:, 1] - lo] = 1
            planes.append(plane)
        out += planes[0] @ planes[1].T
    return out


def histogram(first: list[tuple], second: list[tuple], same: bool, compat: bool) -> dict[int, int]:
    """Weight of each distance between members (id, count, points) of two blocks, or of one with itself, each pair once."""
    spots = [[[p[0] for p in row[2]] for row in side] for side in (first, second)]
    points = [[[(p[0], p[1]) for p in row[2]] for row in side] for side in (first, second)]
    n, m = (np.array([len(row[2]) for row in side]) for side in (first, second))
    apart = (n[:, None] + m - _shared(*spots) - _shared(*points)).round().astype(np.int64)
    a, b = (np.array([row[1] for row in side], np.int64) for side in (first, second))
    if compat:
        order = {x: k for k, x in enumerate(sorted({row[0] for side in (first, second) for row in side}))}
        i, j = (np.array([order[row[0]] for row in side]) for side in (first, second))
        weight = np.where(i[:, None] < j, b, a[:, None])
    else:
        weight = a[:, None] * b
    if same:
        upper = np.triu_indices(len(first), 1)
        apart, weight = apart[upper], weight[upper]
    apart, weight = apart.ravel(), weight.ravel()
    out: dict[int, int] = {}
    if len(apart):
        # Floats would round sums beyond 2**53: both halves of the weights are summed for themselves.
        low, high = (np.bincount(apart, weights=w) for w in (weight & 0xFFFFFF, weight >> 24))
        out = {d: int(high[d]) * (1 << 24) + int(low[d]) for d in np.flatnonzero(low + high).tolist()}
    if same:
        # Sequences of one genotype are equal to each other.
        out[0] = out.get(0, 0) + int((a * (a - 1) // 2).sum())
    return out


def hamming_distribution(genotypes: DataFrame, by: tuple[str, ...] = ("reference_name",), compat: bool = False, block: int = BLOCK) -> DataFrame:
    """Distribution of distances of all pairs of sequences.

    genotypes: by, id, count, points (pos, wt, mut); different ids are different genotypes. compat counts a pair
    with the count of the genotype of the larger id alone. Null counts are 0, null points none.
    """
    scratch = Scratch(genotypes.sparkSession, "distances")
    plain = F.transform(F.coalesce("points", F.array().cast(genotypes.schema["points"].dataType)), lambda x: F.struct(x["pos"].alias("pos"), x["mut"].alias("mut")))
    keys = [f"__g{k}" for k in range(len(by))]
    rows = genotypes.select(F.struct(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True))).alias("__group") if by else F.lit(0).alias("__group"), F.struct("id", F.coalesce(F.col("count").cast("long"), F.lit(0).cast("long")).alias("count"), plain.alias("points")).alias("__row"))
    sizes = scratch.save(rows.groupBy(F.col("__group").alias("__of")).agg(F.ceil(F.count("*") / block).cast("int").alias("__blocks")))
    dealt = rows.join(sizes, F.col("__group").eqNullSafe(F.col("__of"))).withColumn("__block", F.pmod(F.xxhash64("__row.id"), F.col("__blocks")).cast("int"))
    packed = scratch.save(dealt.groupBy("__group", "__blocks", "__block").agg(F.collect_list("__row").alias("__rows")))
    # Every two blocks of a group once, as the row number of each.
    first = packed.withColumn("__with", F.explode(F.sequence(F.col("__block"), F.col("__blocks") - 1)))
    second = packed.select(F.col("__group").alias("__other"), F.col("__block").alias("__at"), F.col("__rows").alias("__second"))
    pairs = first.join(second, F.col("__group").eqNullSafe(F.col("__other")) & (F.col("__with") == F.col("__at")))
    group_type = packed.schema["__group"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                sides = [[(r["id"], r["count"], [(p["pos"], p["mut"]) for p in r["points"]]) for r in batch.column(c)[k].as_py()] for c in (1, 2)]
                found = histogram(*sides, batch.column(3)[k].as_py(), compat)
                take = pa.array([k] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["__group", "d", "w"])

    parts = pairs.select("__group", "__rows", "__second", (F.col("__block") == F.col("__with")).alias("__same"))
    fields = [T.StructField("__group", group_type), T.StructField("d", T.IntegerType()), T.StructField("w", T.LongType())]
    sums = parts.mapInArrow(run, T.StructType(fields)).groupBy("__group", "d").agg(F.sum("w").cast("long").alias("w")).filter("w > 0")
    named = sums.select(*(F.col("__group")[k].alias(c) for c, k in zip(by, keys, strict=True)), "d", "w")
    return distribution(named, "d", list(by), "w")
