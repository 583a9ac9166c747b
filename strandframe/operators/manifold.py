"""Neighbours of genotypes and a non-linear embedding that keeps them together.

The graph of nearest neighbours is found by descent: nodes are first compared
within small blocks (nodes that share the least hash of their changes, and blocks
dealt at random); then every node's neighbours, either way, are compared with
each other, round after round, until few lists change. A block or a list holds a
bounded number of nodes, so no task meets all pairs.

The embedding moves points by three kinds of pairs: near ones of that graph,
mid-near ones (the second nearest of six drawn) and far ones, with the published
weights in three phases. A round deals the points into parts; a task takes
some steps for the points of its part, for which partners in other parts stand still.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strandframe.operators.distances import _shared
from strandframe.scratch import Scratch

#: Nodes that are compared with each other at first, about; deals by least hashes and at random.
BLOCK, SKETCHES, SHUFFLES = 64, 4, 2
#: Points that a task moves, about.
PART = 4096
#: Groups of fewer members get no coordinates.
FEWEST = 10
#: Kinds of pairs.
NEAR, MID, FAR = 0, 1, 2

_FOUND = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("d", T.IntegerType()), T.StructField("tie", T.LongType()), T.StructField("fresh", T.BooleanType())])
_PAIRS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("kind", T.IntegerType())])


def apart(members: list[list[int]]) -> np.ndarray:
    """Positions in which members differ, of all pairs; an item is position * 256 + letter."""
    n = np.array([len(m) for m in members])
    spots = [[x >> 8 for x in m] for m in members]
    return (n[:, None] + n - _shared(spots, spots) - _shared(members, members)).round().astype(np.int64)


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each pair, the same from either end, so that equal distances are not all settled in favour of one node."""
    x = first[:, None] ^ second
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(33))) >> np.uint64(1)


def _nodes(genotypes: DataFrame, by: tuple[str, ...], scratch: Scratch) -> DataFrame:
    """(u, g, id, items, n): one row for each id of a group, numbered by a hash that is seen to be unique; n members in the group."""
    code = lambda p: p["pos"].cast("long") * 256 + F.ascii(p["mut"])
    items = F.array_sort(F.array_distinct(F.transform(F.filter("points", lambda p: p["pos"].isNotNull() & p["mut"].isNotNull()), code)))
    group = F.struct(*(F.col(c) for c in by)) if by else F.struct(F.lit(0).alias("all"))
    rows = genotypes.select(group.alias("g"), F.col("id"), F.coalesce(items, F.array().cast("array<bigint>")).alias("items"))
    rows = scratch.save(rows.groupBy("g", "id").agg(F.min("items").alias("items")))
    for seed in range(64):
        named = rows.withColumn("u", F.xxhash64(F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("")) for c in (F.to_json("g"), F.col("id"))), F.col("id").isNull()))
        if named.groupBy("u").count().filter("count > 1").isEmpty():
            break
    sizes = named.groupBy(F.col("g").alias("of")).agg(F.count("*").alias("n"))
    return scratch.save(named.join(sizes, F.col("g").eqNullSafe(F.col("of"))).drop("of"))


def _blocks(nodes: DataFrame, key: list[Column], seed: Column) -> DataFrame:
    """nodes with a block: those of one group and key, cut by a hash where there are more than about ``BLOCK``."""
    keyed = nodes.withColumn("key", F.xxhash64(F.to_json("g"), *key))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts")).withColumnRenamed("key", "of")
    dealt = keyed.join(sizes, F.col("key") == F.col("of"))
    return dealt.withColumn("block", F.xxhash64("key", F.pmod(F.xxhash64("u", seed), F.col("cuts")))).drop("key", "of", "cuts")


def _compared(lists: DataFrame, neighbours: int) -> DataFrame:
    """Of lists of members (u, items, fresh): the nearest others of each in its list, pairs of two stale ones apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0).to_pylist():
                members = sorted({m["u"]: m for m in members}.values(), key=lambda m: (m["u"], m["fresh"]))
                if len(members) < 2:
                    continue
                u = np.array([m["u"] for m in members], np.int64)
                fresh = np.array([m["fresh"] for m in members])
                d, tie = apart([m["items"] for m in members]), _mixed(u.view(np.uint64), u.view(np.uint64)).astype(np.int64)
                out = ~(fresh[:, None] | fresh)
                np.fill_diagonal(out, True)
                best = np.lexsort((tie, np.where(out, np.iinfo(np.int64).max, d)), axis=1)[:, :neighbours]
                i = np.repeat(np.arange(len(u)), best.shape[1])
                j = best.ravel()
                i, j = i[~out[i, j]], j[~out[i, j]]
                yield pa.RecordBatch.from_arrays([pa.array(u[i]), pa.array(u[j]), pa.array(d[i, j].astype(np.int32)), pa.array(tie[i, j]), pa.array(np.ones(len(i), bool))], _FOUND.names)

    return lists.mapInArrow(run, _FOUND)


def _nearest(found: DataFrame, neighbours: int) -> DataFrame:
    once = found.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("tie").alias("tie"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "tie", "v"))
    return once.withColumn("r", rank).filter(F.col("r") <= neighbours).drop("r")


def _graph(nodes: DataFrame, neighbours: int, rounds: int, settled: float, scratch: Scratch) -> DataFrame:
    member = F.struct("u", "items", F.lit(True).alias("fresh"))
    deals = []
    for t in range(SKETCHES):
        deals.append(F.struct(F.lit(t).alias("t"), F.coalesce(F.array_min(F.transform("items", lambda x: F.xxhash64(x, F.lit(t)))), F.lit(0)).alias("key")))  # noqa: B023
    deals += [F.struct(F.lit(SKETCHES + t).alias("t"), F.lit(0).cast("long").alias("key")) for t in range(SHUFFLES)]
    dealt = nodes.withColumn("deal", F.explode(F.array(*deals)))
    lists = _blocks(dealt, [F.col("deal.t"), F.col("deal.key")], F.col("deal.t")).groupBy("block").agg(F.collect_list(member).alias("members"))
    found = _compared(lists.select("members"), neighbours)
    graph = scratch.save(_nearest(found, neighbours))
    wanted = nodes.count() * neighbours * settled
    for t in range(rounds):
        ways = graph.select(F.col("u").alias("at"), F.col("v").alias("u"), "fresh").unionByName(graph.select(F.col("v").alias("at"), "u", "fresh"))
        ways = ways.groupBy("at", "u").agg(F.max("fresh").alias("fresh"))
        # A node that many others hold as a neighbour takes part with some of them, others in each round.
        draw = F.row_number().over(Window.partitionBy("at", "fresh").orderBy(F.xxhash64("at", "u", F.lit(t)), "u"))
        drawn = ways.withColumn("r", draw).filter(F.col("r") <= 2 * neighbours)
        lists = drawn.join(nodes.select("u", "items"), "u").groupBy("at").agg(F.collect_list(F.struct("u", "items", "fresh")).alias("members"))
        met = _compared(lists.filter(F.exists("members", lambda m: m["fresh"])).select("members"), neighbours)
        graph = scratch.save(_nearest(graph.withColumn("fresh", F.lit(False)).unionByName(met), neighbours))
        if graph.filter("fresh").count() <= wanted:
            break
    return graph


def neighbours(genotypes: DataFrame, k: int = 10, by: tuple[str, ...] = ("reference_name",), rounds: int = 12, settled: float = 0.001) -> DataFrame:
    """(by, id, neighbour, distance): for each genotype k others of its group that differ in fewest positions, nearly always the nearest.

    genotypes: by, id, points (pos, mut). Repeated ids of a group are one genotype, with the least of their
    points; null points are none. Rounds end when no more than the settled share of the graph changes.
    Groups of k members or fewer give all of their pairs.
    """
    scratch = Scratch(genotypes.sparkSession, "neighbours")
    nodes = _nodes(genotypes, by, scratch)
    graph = _graph(nodes, k, rounds, settled, scratch)
    ends = nodes.select("u", "g", "id"), nodes.select(F.col("u").alias("v"), F.col("id").alias("neighbour"))
    return graph.join(ends[0], "u").join(ends[1], "v").select(*(F.col("g")[c].alias(c) for c in by), "id", "neighbour", F.col("d").alias("distance"))


def _drawn(nodes: DataFrame, mids: float, fars: float, seed: int) -> DataFrame:
    """Mid-near and far pairs of all nodes, from blocks dealt at random: numbers are by neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0).to_pylist():
                members.sort(key=lambda m: m["u"])
                u = np.array([m["u"] for m in members], np.int64)
                if len(u) < 2:
                    continue
                d = apart([m["items"] for m in members])
                rnd = np.random.default_rng([seed, len(u), int(u.view(np.uint64)[0] >> np.uint64(1))])
                out = []
                for i, m in enumerate(members):
                    others = np.delete(np.arange(len(u)), i)
                    for _ in range(max(1, round(m["k"] * mids))):
                        six = rnd.choice(others, min(6, len(others)), replace=False)
                        out.append((i, six[np.argsort(d[i, six], kind="stable")[min(1, len(six) - 1)]], MID))
                    far = rnd.choice(others, min(max(1, round(m["k"] * fars)), len(others)), replace=False)
                    out.extend((i, j, FAR) for j in far)
                i, j, kind = np.array(out, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(u[i]), pa.array(u[j]), pa.array(kind.astype(np.int32))], _PAIRS.names)

    lists = _blocks(nodes, [F.lit("drawn")], F.lit(seed)).groupBy("block").agg(F.collect_list(F.struct("u", "items", "k")).alias("members"))
    return lists.select("members").mapInArrow(run, _PAIRS)


def _weights(step: int, steps: int) -> tuple[float, float, float]:
    """Published weights of near, mid-near and far pairs: two ninths of the steps each for the first two phases."""
    first = steps * 2 / 9
    if step < first:
        return 2.0, 1000.0 + (3.0 - 1000.0) * step / first, 1.0
    return (3.0, 3.0, 1.0) if step < 2 * first else (1.0, 0.0, 1.0)


def _settle(u: np.ndarray, state: np.ndarray, pairs: tuple[np.ndarray, ...], steps: range, total: int) -> np.ndarray:
    """state (place, first and second moments) of points u after some steps of gradient descent with moments.

    pairs: place of the point in u, its partner, kind, and where the partner stands.
    Pairs within the part move both ends, others the one that is here.
    """
    y, first, second = (s.copy() for s in state)
    i, v, kind, stand = pairs
    j = np.searchsorted(u, v).clip(max=len(u) - 1)
    here = u[j] == v
    scale = np.array([10.0, 10000.0, 1.0])[kind]
    for step in steps:
        w = np.array(_weights(step, total))[kind]
        w[kind == FAR] *= -1
        gap = y[i] - np.where(here[:, None], y[j], stand)
        slope = (2 * w * scale / (scale + 1 + (gap**2).sum(1)) ** 2)[:, None] * gap
        # The far term is 1 / (1 + d), d being 1 and the squared distance, as in the other two.
        pull = np.stack([np.bincount(i, slope[:, c], len(u)) - np.bincount(j[here], slope[here, c], len(u)) for c in range(y.shape[1])], 1)
        first = 0.9 * first + 0.1 * pull
        second = 0.999 * second + 0.001 * pull**2
        y -= np.sqrt(1 - 0.999 ** (step + 1)) / (1 - 0.9 ** (step + 1)) * first / (np.sqrt(second) + 1e-7)
    return np.stack([y, first, second])


def embed(
    genotypes: DataFrame, k: int = 10, by: tuple[str, ...] = ("reference_name",), dimensions: int = 2,
    mids: float = 0.5, fars: float = 2.0, steps: int = 450, rounds: int = 15, name: str = "EMB", seed: int = 0,
) -> DataFrame:
    """genotypes with coordinates name1, name2, ... of an embedding by pairs, a group at a time.

    Groups of fewer than ten genotypes get nulls, groups of fewer than fifty a fifth of their number as neighbours,
    others k; mids and fars are pairs for each neighbour. Points start at a random projection of their changes. One
    part's points (all, up to about ``PART``) move as in the published method; with more parts, partners elsewhere
    stand still for steps / rounds steps. Repeated ids of a group are one genotype.
    """
    scratch = Scratch(genotypes.sparkSession, "manifold")
    every = _nodes(genotypes, by, scratch)
    nodes = scratch.save(every.filter(F.col("n") >= FEWEST).withColumn("k", F.when(F.col("n") < 50, F.greatest(F.lit(2), F.floor(F.col("n") / 5))).otherwise(k).cast("int")))
    graph = _graph(nodes, k, 12, 0.001, scratch)
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "tie", "v"))
    near = graph.withColumn("r", rank).join(nodes.select("u", "k"), "u").filter("r <= k").select("u", "v", F.lit(NEAR).alias("kind"))
    # A far pair is no near one.
    drawn = scratch.save(_drawn(nodes, mids, fars, seed))
    others = drawn.join(near.select("u", "v", F.lit(True).alias("close")), ["u", "v"], "left").filter((F.col("kind") != FAR) | F.col("close").isNull())
    pairs = scratch.save(near.unionByName(others.drop("close")))

    axis = lambda c: F.aggregate("items", F.lit(0.0), lambda s, x: s + F.pmod(F.xxhash64(x, F.lit(c), F.lit(seed)), F.lit(2001)) / 1000.0 - 1.0)
    # Equal starts would never part: a point's own hash moves it a little.
    start = F.array(*(axis(c) * 0.01 + F.pmod(F.xxhash64("u", F.lit(c)), F.lit(2001)) * 1e-7 for c in range(dimensions)))
    zeros = F.array(*[F.lit(0.0)] * dimensions)
    state = scratch.save(nodes.select("u", start.alias("y"), zeros.alias("first"), zeros.alias("second")))
    parts = -(-max(nodes.count(), 1) // PART)
    cuts = [steps * r // rounds for r in range(rounds + 1)]
    fields = state.schema

    def mover(at: int, end: int):
        def move(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("u")
            u = part["u"].to_numpy()
            held = np.stack([np.stack(part[c].to_list()).astype(float) for c in ("y", "first", "second")])
            sizes = [len(p) for p in part["partners"]]
            flat = [x for p in part["partners"] for x in p]
            i = np.repeat(np.arange(len(u)), sizes)
            v, kind = np.array([x["v"] for x in flat], np.int64), np.array([x["kind"] for x in flat], np.int64)
            stand = np.array([x["y"] for x in flat], float).reshape(-1, dimensions)
            y, first, second = _settle(u, held, (i, v, kind, stand), range(at, end), steps)
            return pd.DataFrame({"u": u, "y": list(y), "first": list(first), "second": list(second)})

        return move

    for r, (at, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        stands = pairs.join(state.select(F.col("u").alias("v"), "y"), "v").groupBy("u").agg(F.array_sort(F.collect_list(F.struct("kind", "v", "y"))).alias("partners"))
        dealt = state.join(stands, "u").withColumn("part", F.pmod(F.xxhash64("u", F.lit(r)), F.lit(parts)))
        state = scratch.save(dealt.groupBy("part").applyInPandas(mover(at, end), fields))
    places = every.select("u", "g", F.col("id").alias("__id")).join(state, "u", "left").select("g", "__id", *(F.col("y")[c].alias(f"{name}{c + 1}") for c in range(dimensions)))
    group = F.struct(*(F.col(c) for c in by)) if by else F.struct(F.lit(0).alias("all"))
    out = genotypes.withColumn("__g", group).join(places, F.col("__g").eqNullSafe(F.col("g")) & F.col("id").eqNullSafe(F.col("__id")))
    return out.drop("__g", "g", "__id")
