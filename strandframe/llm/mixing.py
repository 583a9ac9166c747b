"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

*Targets.* Sources share ``budget`` words by weight. No source gives more than
``repeats`` times its words; what a capped source cannot give is shared by
weight among the others until none is above its cap.

*Quotas.* The budget is cut into blocks of equal size, and the mix into ``shards``
runs of blocks. A block has ``block`` words, or a ``SHARE`` of the smallest target if
that is less, so that no source is too small for a quota. Blocks go one by one to the
source with the highest quotient target / (2j + 1), j blocks held. The method never takes a block back
when more are awarded, so the quota of a source in a shard is the difference of
its quotas at the shard's ends.

*Blocks.* A source's documents, in the order of a seeded hash, are one line of
words, cut into blocks, which a seeded permutation puts in order. Shard after
shard takes as many blocks as its quota says, from where the last one stopped,
and begins anew at the first block when all are used: no block is taken twice
more often than another.

The line is laid out by two-level prefix sums (hash buckets of some ``PER_BUCKET``
rows, then documents of a bucket), so a source that holds most rows is spread
over tasks. Equal rows are one stretch of the line, whose parts they are given by
number, so a row that repeats is not sorted in one task either. Only ids and sizes
are laid out; ``resample`` joins the texts last. A text's blocks are not listed: how
many of a run of blocks stand before a place in the order is a sum of floors, which
takes as many steps as a greatest common divisor, whatever the length of the text.

Outputs are named as ``OUTPUTS``; input columns of such names are kept with ``_in``
appended. Defined cases: a null or blank text has size 0 and nothing is taken of
it. A null source is a source of its own. Sources of size 0 get nothing. Repeated
rows are separate stock; rows with equal hash, id and size are interchangeable.
Null weights count as 0; when all weights are 0 nothing is taken. An empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from strandframe.llm._names import all_of, col, make_room, prefix
from strandframe.llm._store import Scratch

OUTPUTS = ("__size", "__source_size", "__target", "__quota", "__taken", "__by_shard")
#: Rows of a bucket, about; at least LEAST_BUCKETS buckets are made.
PER_BUCKET, LEAST_BUCKETS = 1 << 15, 1024
#: A block is at most this share of the smallest target.
SHARE = 1 / 12
#: Equal rows beyond so many are split into so many parts where rows meet their stretch.
MANY_EQUAL, PARTS = 1 << 15, 32
#: Sources that the driver apportions among; each needs some hundred bytes.
MOST_SOURCES = 1_000_000


def size_of(text: Column) -> Column:
    """Number of words, by the changes from white space to other characters."""
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(blank, r"[\x20\x09-\x0D]+", "")).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, budget: float, repeats: float) -> np.ndarray:
    """Words of each source: shares of the budget by weight, capped at repeats times its size."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, cap = np.zeros(len(sizes)), repeats * sizes
    free = (weights > 0) & (sizes > 0)
    left = float(budget)
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > cap)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap[over]
        left -= cap[over].sum()
        free &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats of each party by highest quotients votes / (2j + 1); ties go to the earlier party.

    Only quotients near the divisor can be decisive: everything below is
    awarded at once, and the rest, O(parties) quotients, is sorted.
    """
    votes = np.asarray(votes, float)
    if seats <= 0 or not votes.sum():
        return np.zeros(len(votes), np.int64)
    share = votes * (seats / votes.sum())
    if seats < len(votes):
        low, high = np.zeros(len(votes), np.int64), np.minimum(np.ceil(share * 2).astype(np.int64) + 2, seats)
        if (votes > 0).sum() * 2 < seats:
            high[:] = seats
    else:
        reach = np.ceil(share * (len(votes) / seats)).astype(np.int64) + 2
        low, high = np.maximum(0, np.floor(share).astype(np.int64) - reach), np.floor(share).astype(np.int64) + reach
    low = np.where(votes > 0, low, 0)
    high = np.where(votes > 0, np.maximum(high, low), 0)
    party = np.repeat(np.arange(len(votes)), high - low)
    j = np.arange(len(party)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[party]
    rest = seats - int(low.sum())
    order = np.lexsort((party, -(votes[party] / (2 * j + 1))))[:rest]
    return low + np.bincount(party[order], minlength=len(votes))


def shard_ends(blocks: int, shards: int) -> list[int]:
    """Blocks awarded up to the end of each shard."""
    return [-(-blocks * (j + 1) // shards) for j in range(shards)]


def shard_quotas(votes: np.ndarray, blocks: int, shards: int) -> np.ndarray:
    """(shards, sources) integer quotas; their sum is the apportionment of all blocks."""
    at = np.stack([sainte_lague(votes, n) for n in shard_ends(blocks, shards)])
    return np.diff(np.concatenate([np.zeros((1, len(votes)), np.int64), at]), axis=0)


def block_size(goal: np.ndarray, block: int) -> int:
    """Words of a block: block, or less if that is more than a SHARE of the smallest target."""
    some = goal[goal > 0]
    return max(1, min(block, math.floor(some.min() * SHARE))) if len(some) else block


def _order(source: str | None, blocks: int, seed: int) -> tuple[int, int]:
    """Factor and shift of a source's block order, drawn by the seed; their products with block numbers fit 64 bits."""
    draw = hashlib.md5(f"{seed}:{source is None}:{source}".encode()).digest()
    most = min(blocks, 1 << 20, max(1, (1 << 61) // blocks))
    step = int.from_bytes(draw[:8], "big") % most + 1
    while math.gcd(step, blocks) != 1:
        step = step % most + 1
    return step, int.from_bytes(draw[8:], "big") % blocks


def _reach(words: int, size: int, blocks: int, block: int, last: int) -> int:
    """Blocks, whole passes and the start of another, that come nearest to so many words of a source.

    last: the place in the order of the line's last block, which may be shorter.
    """
    if not size:
        return 0
    passes, rest = divmod(words, size)
    near = [min(rest // block + k, blocks) for k in range(3)]
    return passes * blocks + min(near, key=lambda n: (abs(n * block - (blocks * block - size) * (n > last) - rest), n))


def plan(stock: list[tuple], weights: dict, budget: float | None, repeats: float, block: int, shards: int, seed: int) -> list[tuple]:
    """(source, size, target, quota, width, blocks, step, shift, reach) per source; width: words of a block; reach: blocks taken by the end of each shard."""
    sizes = np.array([s for _, s in stock], float)
    total = sizes.sum() if budget is None else budget
    goal = targets(sizes, np.array([weights.get(s, 0.0) or 0.0 for s, _ in stock], float), total, repeats)
    width = block_size(goal, block)
    quotas = shard_quotas(goal, round(goal.sum() / width), shards).cumsum(axis=0)
    rows = []
    for x, ((source, size), target) in enumerate(zip(stock, goal.tolist(), strict=True)):
        most, blocks = math.floor(repeats * size), max(1, -(-size // width))
        step, shift = _order(source, blocks, seed)
        last = ((blocks - 1) * step + shift) % blocks
        reach = [_reach(min(q * width, most), size, blocks, width, last) for q in quotas[:, x].tolist()]
        rows.append((source, size, target, int(quotas[-1, x]), width, blocks, step, shift, reach))
    return rows


def floor_sums(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of floor((a * i + b) / m) over i in 0..n-1, for arrays; a, b >= 0.

    Whole parts of a / m and b / m are summed at once; what is left counts points
    below a line, which are counted along the other axis in the next step.
    """
    out, at = np.zeros(len(n), np.int64), np.arange(len(n))
    while len(at):
        out[at] += n * (n - 1) // 2 * (a // m) + n * (b // m)
        a, top = a % m, (a % m) * n + b % m
        go = top >= m
        at, n, m, a, b = at[go], (top // m)[go], a[go], m[go], (top % m)[go]
    return out


def words_taken(lo, hi, width, blocks, step, shift, reach: np.ndarray) -> np.ndarray:
    """Words of [lo, hi) of the line among the first reach blocks in the order, again from the first when all are used.

    Arrays of one length; reach has a column per shard, and so has the result.
    """
    shards = reach.shape[1]
    lo, hi, width, blocks, step, shift = (np.repeat(np.asarray(x, np.int64), shards) for x in (lo, hi, width, blocks, step, shift))
    passes, rest = np.divmod(reach.reshape(-1), blocks)
    first, last = lo // width, np.maximum(hi - 1, lo) // width
    place = lambda k: (k * step + shift) % blocks
    out = passes * (hi - lo) + np.where(place(first) < rest, np.minimum(hi, (first + 1) * width) - lo, 0)
    out += np.where((last > first) & (place(last) < rest), hi - last * width, 0)
    some = np.flatnonzero((last - first > 1) & (rest > 0))
    n, m, a, b, r = (last - first - 1)[some], blocks[some], step[some], place(first + 1)[some], rest[some]
    out[some] += width[some] * (floor_sums(n, m, a, b + m) - floor_sums(n, m, a, b + m - r))
    return out.reshape(-1, shards)


@F.pandas_udf(ArrayType(LongType()))
def _upto(lo: pd.Series, hi: pd.Series, width: pd.Series, blocks: pd.Series, step: pd.Series, shift: pd.Series, reach: pd.Series) -> pd.Series:
    if not len(lo):
        return pd.Series([], dtype=object)
    return pd.Series(list(words_taken(lo, hi, width, blocks, step, shift, np.stack(reach.to_numpy()))))


def _rows(docs: DataFrame, p: str, names: list[str], id_col: str, text_col: str, source_col: str, seed: int, whole: bool) -> DataFrame:
    """The named columns with key (of the id and text, or of the whole row), source, size, id and a number of the row, to be written."""
    parts = all_of(docs.columns) if whole else [col(id_col), col(text_col)]
    key = F.xxhash64(F.lit(seed), *parts)
    return docs.select(
        *all_of(names), key.alias(f"{p}key"), col(source_col).cast("string").alias(f"{p}s"), size_of(col(text_col)).alias("__size"),
        col(id_col).alias(f"{p}id"), F.monotonically_increasing_id().alias(f"{p}row"),
    )


INNER = ("begin", "width", "blocks", "step", "shift", "reach")


def _lay_out(rows: DataFrame, scratch: Scratch, p: str, weights, weigh, budget, repeats, block: int, shards: int, seed: int) -> DataFrame:
    """Equal rows, counted, with their place on the source's line and what is known of the source."""
    spark, buckets = scratch.spark, max(LEAST_BUCKETS, rows.count() // PER_BUCKET)
    same = [F.col(f"{p}s").alias("s"), F.col(f"{p}key").alias("key"), F.col(f"{p}id").alias("id"), F.col("__size").alias("n")]
    equal = scratch.save(rows.groupBy(*same).agg(F.count("*").alias("c")).withColumn("b", F.pmod("key", F.lit(buckets))), "equal")
    sums = scratch.save(equal.groupBy("s", "b").agg(F.sum(F.col("n") * F.col("c")).alias("n")), "sums")
    per_source = sums.groupBy("s").agg(F.sum("n").cast("long").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(per_source) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    stock = sorted(((r.s, r.n) for r in per_source), key=lambda r: (r[0] is None, r[0] or ""))
    weights = weigh([s for s, _ in stock]) if weigh else weights or {s: 1.0 for s, _ in stock}
    schema = "qs string, __source_size long, __target double, __quota long, width long, blocks long, step long, shift long, reach array<long>"
    quotas = spark.createDataFrame(plan(stock, weights, budget, repeats, block, shards, seed) if stock else [], schema)
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    offsets = offsets.join(quotas, F.col("s").eqNullSafe(F.col("qs"))).drop("qs").withColumnsRenamed({"s": "os", "b": "ob"})
    joined = equal.join(offsets, F.col("s").eqNullSafe(F.col("os")) & (F.col("b") == F.col("ob"))).drop("os", "ob")
    inside = Window.partitionBy("s", "b").orderBy("key", "id", "n").rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("begin", (F.col("begin") + F.coalesce(F.sum(F.col("n") * F.col("c")).over(inside), F.lit(0))).cast("long"))


def _numbered(rows: DataFrame, laid: DataFrame, p: str) -> DataFrame:
    """rows with what laid says of them, and begin moved to where the row's own part of the stretch begins."""
    part = F.when(F.col("c") > MANY_EQUAL, F.sequence(F.lit(0), F.lit(PARTS - 1)))
    laid = laid.withColumn("part", F.explode(F.coalesce(part, F.array(F.lit(-1))))).withColumnsRenamed({c: f"{p}o_{c}" for c in ("s", "b", "key", "id", "n", "c", "part", *INNER)})
    o = lambda c: F.col(f"{p}o_{c}")
    met = (F.col(f"{p}key") == o("key")) & F.col(f"{p}s").eqNullSafe(o("s")) & F.col(f"{p}id").eqNullSafe(o("id")) & (F.col("__size") == o("n"))
    whole = rows.join(laid.filter(o("part") < 0), met)
    once = whole.filter(o("c") == 1)
    if laid.filter(o("c") > 1).isEmpty():
        return once
    split = rows.withColumn(f"{p}part", F.pmod(F.xxhash64(f"{p}row"), F.lit(PARTS)).cast("int")).join(laid.filter(o("part") >= 0), met & (F.col(f"{p}part") == o("part")))
    several = whole.filter(o("c") > 1).unionByName(split.drop(f"{p}part"))
    # Number of a row among its equals: those of earlier runs of 2^20 row numbers, then those before it in its own run.
    several = several.withColumn(f"{p}task", F.shiftright(F.col(f"{p}row"), 20))
    group = [f"{p}o_{c}" for c in ("s", "key", "id", "n")]
    earlier = Window.partitionBy(*group).orderBy(f"{p}task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = several.groupBy(*group, f"{p}task").agg(F.count("*").alias("k"))
    tasks = tasks.select(*(F.col(g).alias(f"{p}g{x}") for x, g in enumerate(group)), F.col(f"{p}task").alias(f"{p}gt"), F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias(f"{p}k"))
    met = (F.col(f"{p}task") == F.col(f"{p}gt")) & (o("key") == F.col(f"{p}g1"))
    for x, c in ((0, "s"), (2, "id"), (3, "n")):
        met = met & o(c).eqNullSafe(F.col(f"{p}g{x}"))
    number = F.col(f"{p}k") + F.row_number().over(Window.partitionBy(*group, f"{p}task").orderBy(f"{p}row")) - 1
    several = several.join(tasks, met).withColumn(f"{p}o_begin", o("begin") + number * F.col("__size"))
    return once.unionByName(several.select(*all_of(once.columns)))


def _upto_words(lo: Column, hi: Column, o) -> Column:
    return _upto(lo, hi, *(o(c) for c in INNER[1:]))


def mix(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    budget: float | None = None, repeats: float = 3.0, block: int = 64, shards: int = 16, seed: int = 1, weigh=None, columns: list[str] | None = None,
) -> DataFrame:
    """Every row of docs with the columns OUTPUTS: its words, its source's words, target and quota, and the words taken, in all and by shard.

    weights: by source (None for the null source); or weigh: from the sources
    found, by code point and null last, to such a dict. columns: those of docs to
    return, all by default; if they leave out the text, it is read once.
    """
    docs = make_room(docs, list(OUTPUTS), [id_col, text_col, source_col])
    p, scratch, names = prefix(docs), Scratch(docs.sparkSession, "mix"), docs.columns if columns is None else columns
    rows = scratch.save(_rows(docs, p, names, id_col, text_col, source_col, seed, False), "rows")
    laid = scratch.save(_lay_out(rows, scratch, p, weights, weigh, budget, repeats, block, shards, seed), "laid")
    placed = _numbered(rows, laid, p)
    o = lambda c: F.col(f"{p}o_{c}")
    placed = placed.withColumn(f"{p}upto", _upto_words(o("begin"), o("begin") + F.col("__size"), o))
    by_shard = F.transform(f"{p}upto", lambda x, i: x - F.coalesce(F.get(F.col(f"{p}upto"), i - 1), F.lit(0).cast("long")))
    out = placed.withColumn("__by_shard", by_shard).withColumn("__taken", F.get(F.col(f"{p}upto"), F.lit(shards - 1)))
    return out.select(*all_of(names), *OUTPUTS)


def rotating(sources: list) -> dict:
    """Weights 1, 2, 3, 1, ... for the sources in the given order."""
    return {s: float(i % 3 + 1) for i, s in enumerate(sources)}


def resample(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    budget: float | None = None, repeats: float = 3.0, block: int = 64, shards: int = 16, seed: int = 1, weigh=None,
) -> DataFrame:
    """The mix as whole documents: each row as often as words taken / size, the fraction by a seeded draw.

    The copies of a row are decided without its text, which is joined by a hash
    of the whole row; rows equal in all columns share what they are given.
    """
    p, scratch, names = prefix(docs), Scratch(docs.sparkSession, "resample"), docs.columns
    rows = scratch.save(_rows(docs, p, [], id_col, text_col, source_col, seed, True), "rows")
    laid = scratch.save(_lay_out(rows, scratch, p, weights, weigh, budget, repeats, block, shards, seed), "laid")
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), "key", "begin"), F.lit(1 << 30)) / float(1 << 30)
    taken = F.get(_upto_words(F.col("begin"), F.col("begin") + F.col("n") * F.col("c"), F.col), F.lit(shards - 1))
    times = laid.filter(F.col("n") > 0).withColumn("t", F.floor(taken / F.col("n") + draw).cast("long"))
    times = times.groupBy(F.col("key").alias(f"{p}of")).agg(F.sum("t").alias(f"{p}t"), F.sum("c").alias(f"{p}c")).filter(F.col(f"{p}t") > 0)
    times = scratch.save(times, "times")
    keyed = docs.withColumn(f"{p}key", F.xxhash64(F.lit(seed), *all_of(names)))
    matched = F.col(f"{p}key") == F.col(f"{p}of")
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{p}t").cast("int")))
    out = keyed.join(times.filter(F.col(f"{p}c") == 1), matched).withColumn(f"{p}copy", copies).select(*all_of(names))
    repeated = times.filter(F.col(f"{p}c") > 1)
    if repeated.isEmpty():
        return out
    # One row stands for its equals, found by partial aggregation; the second hash keeps differing rows of one key apart.
    same = F.concat_ws(":", F.col(f"{p}key"), F.xxhash64(F.lit(~seed), *all_of(names))).alias(f"{p}same")
    row = F.first(F.struct(*all_of(names))).alias(f"{p}row")
    ones = keyed.join(repeated, matched).groupBy(same).agg(row, F.first(f"{p}t").alias(f"{p}t"))
    return out.unionByName(ones.withColumn(f"{p}copy", copies).select(f"{p}row.*"))
