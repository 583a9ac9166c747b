"""Prefix trie of conversations by partition refinement.

A node is a distinct sequence of first turns; its members are the conversations
that start with it. All conversations start in one class, the root. A round takes
the next block of turns of every conversation that is still active, splits its
class turn after turn (the class of a turn is a digest of the class before and the
turn, so equal beginnings meet without a table of classes), and counts the
members of each class. Blocks double, from ``FIRST`` to ``MOST`` turns, so the
number of rounds grows with the logarithm of the longest common beginning.
Conversations alone in their class at the end of a block retire: what is left
of them is a unary chain, whose nodes are emitted from its length alone.

*Folding back.* The smallest member owns a node; so a conversation owns one run
of nodes, from the depth where it becomes the smallest to its end. What a
conversation adds to the nodes above its run follows from where its run begins:
it is a child of the node before, and the bytes of the turns from a node down to
there are bytes that another one has already. Sums of these over the members of
each class are children, leaves and saved bytes of whole subtrees, in one aggregation.

No group is gathered: classes are aggregated by partial sums, joins are of plain
shuffles, turns are numbered within ranges of ``1 << RANGE`` turn numbers whose sizes
are summed first, and blocks hold at most ``MOST`` turns. Ids that end at a node are
digested in ascending order by streaming them, packed into runs of ``RUN`` ids.

Defined cases: null role or text counts as empty; rows of null id belong to no
conversation and are left out; null turns come first; equal turns are in the order
of role, then text (equal turn numbers of one range are numbered by one task). Repeated
rows are turns each. Other columns are ignored. An empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.llm._names import col
from strandframe.llm._store import Scratch, ready

#: Turns of the first and of the largest block; turn numbers of a range, as a power of two; ids packed together; turns of a chain emitted at once.
FIRST, MOST, RANGE, RUN, CHAIN = 4, 4096, 8, 4096, 4096
ROOT = hashlib.md5(b"").digest()
_EMPTY = hashlib.sha256(b"").hexdigest()
_STEPS = "conv_id long, n long, depth long, parent binary, class binary, size long, upto long"


def numbered(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, pos from 0, key, size) and conversations as (conv_id, turns).

    key is a digest of role and text, size the bytes of the text.
    """
    scratch = Scratch(talks.sparkSession, "turns")
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    rows = talks.select(col(conv_col).cast("long").alias("conv_id"), col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).filter("conv_id is not null")
    rows = rows.withColumn("range", F.coalesce(F.shiftright("turn", RANGE), F.lit(-(1 << 63))))
    sizes = scratch.save(rows.groupBy("conv_id", "range").agg(F.count("*").alias("n")), "ranges")
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "range").orderBy(F.asc_nulls_first("turn"), "role", "text")
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit("|"), "role", F.lit("|"), "text").cast("binary")))
    placed = rows.join(starts, ["conv_id", "range"]).withColumn("pos", F.col("start") + F.row_number().over(inside) - 1)
    turns = placed.select("conv_id", F.col("pos").cast("long").alias("pos"), key.alias("key"), F.octet_length("text").cast("long").alias("size"))
    return turns, sizes.groupBy("conv_id").agg(F.sum("n").cast("long").alias("turns"))


def rebuild(talks: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first one: turns (conv_id, depth, key, size) and (conv_id, n).

    Of conversation c, h = crc32(c) % most turns come from conversation c - c % group,
    as far as it has them, and the others from itself, behind its own first h.
    """
    spark = talks.sparkSession
    scratch = Scratch(spark, "rebuilt")
    turns, convs = numbered(talks)
    turns, convs = scratch.save(turns, "turns"), scratch.save(convs, "convs")
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("head")
    mine = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head)
    theirs = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    plan = mine.join(theirs, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_turns", F.lit(0))))
    plan = scratch.save(plan.select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("turns") - F.col("head"))).alias("n")), "plan")
    own = turns.join(plan.select("conv_id", "head", "taken"), "conv_id").filter("pos >= head").select("conv_id", (F.col("taken") + F.col("pos") - F.col("head") + 1).alias("depth"), "key", "size")
    given = turns.filter(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base").join(plan.select("conv_id", "base", "taken"), "base").filter("pos < taken")
    return own.unionByName(given.select("conv_id", (F.col("pos") + 1).alias("depth"), "key", "size")), plan.select("conv_id", "n")


def _ends() -> list[int]:
    """Last depths of the first blocks that together double up to MOST."""
    out, size = [0], FIRST
    while size < MOST:
        out.append(out[-1] + size)
        size *= 2
    return out


def _block(depth: Column) -> Column:
    """The block of a depth, from 0."""
    ends = _ends()
    later = F.lit(len(ends) - 1) + F.floor((depth - 1 - ends[-1]) / MOST)
    out = later
    for b in range(len(ends) - 1, 0, -1):
        out = F.when(depth <= ends[b], F.lit(b - 1)).otherwise(out)
    return out.cast("int")


def _last(block: int) -> int:
    ends = _ends()
    return ends[block + 1] if block + 1 < len(ends) else ends[-1] + MOST * (block + 2 - len(ends))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of every turn of a block, each from the class before."""
    names = [f.split()[0] for f in _STEPS.split(", ")]
    for batch in batches:
        out = [[] for _ in names]
        for conv, n, depth, now, upto, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for turn in block:
                before, now = now, hashlib.md5(now + turn["key"]).digest()
                upto += turn["size"]
                for column, value in zip(out, (conv, n, turn["depth"], before, now, turn["size"], upto), strict=True):
                    column.append(value)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _classes(steps: DataFrame) -> DataFrame:
    """One row per class: members, the smallest, how deep the deepest goes, and what all share."""
    return steps.groupBy("class").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("n").alias("deepest"),
        F.first("depth").alias("depth"), F.first("size").alias("size"), F.first("upto").alias("upto"),
    )


def refine(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(steps, classes): every turn of a conversation until it retires with the class it leads to, and all these classes, the root first."""
    spark = turns.sparkSession
    block = F.array_sort(F.collect_list(F.struct("depth", "key", "size")))
    blocks = turns.groupBy("conv_id", _block(F.col("depth")).alias("block")).agg(block.alias("turns"))
    path = scratch.path("blocks")
    blocks.write.partitionBy("block").parquet(path)
    blocks = spark.read.schema("conv_id long, turns array<struct<depth: long, key: binary, size: long>>, block int").parquet(path)
    root = F.lit(bytearray(ROOT))
    zero = F.lit(0).cast("long")
    steps = [scratch.save(convs.select("conv_id", "n", zero.alias("depth"), F.lit(None).cast("binary").alias("parent"), root.alias("class"), zero.alias("size"), zero.alias("upto")), "root")]
    classes = [scratch.save(_classes(steps[0]), "classes")]
    active = steps[0].filter("n > 0").select("conv_id", "n", "depth", "class", "upto")
    if classes[0].filter("n_convs > 1").isEmpty():
        return steps[0], classes[0]
    number = 0
    while not active.isEmpty():
        now = active.join(blocks.filter(F.col("block") == number).select("conv_id", "turns"), "conv_id")
        steps.append(scratch.save(now.mapInArrow(_split, _STEPS), "steps"))
        classes.append(scratch.save(_classes(steps[-1]), "classes"))
        at_end = F.col("depth") == _last(number)
        shared = classes[-1].filter(at_end & (F.col("n_convs") > 1) & (F.col("deepest") > F.col("depth"))).select("class")
        going = steps[-1].filter(at_end & (F.col("n") > F.col("depth"))).join(shared, "class", "left_semi")
        active = scratch.save(going.select("conv_id", "n", "depth", "class", "upto"), "active")
        number += 1
    every = lambda frames, schema: spark.read.schema(schema).parquet(*(f._scratch_path for f in frames))
    return every(steps, steps[0].schema), every(classes, classes[0].schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (class, conv_id) as runs of at most RUN decimal ids."""
    names = ["class", "first", "ids"]
    now, ids = None, []

    def done() -> tuple:
        return now, ids[0], ",".join(map(str, ids))

    for batch in batches:
        out = []
        for c, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (c != now or len(ids) == RUN):
                out.append(done())
                ids = []
            now = c
            ids.append(i)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(done(), (pa.binary(), pa.int64(), pa.string()), strict=True)], names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of ids as one digest per class."""
    now, digest = None, None
    for batch in batches:
        out = []
        for c, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if c != now:
                if now is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = c, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["class", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["class", "ends"])


def _end_digests(steps: DataFrame) -> DataFrame:
    """(class, ends): digests of the ids that end at each class."""
    ends = steps.filter("n = depth").select("class", "conv_id")
    runs = ends.repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id").mapInArrow(_packed, "class binary, first long, ids string")
    return runs.repartition("class").sortWithinPartitions("class", "first").mapInArrow(_digested, "class binary, ends string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (bytes), ends_sha256.

    turns: conv_id, depth (from 1 without gaps), key, size; convs: conv_id, n (turns).
    """
    spark = turns.sparkSession
    ready(spark)
    scratch = Scratch(spark, "trie")
    steps, classes = refine(turns, convs, scratch)
    # Where the run that a conversation owns begins, the bytes before it, and whether it ends at a leaf.
    leaf = (F.col("deepest") == F.col("depth")) | (F.col("n_convs") == 1)
    owned = classes.select(F.col("owner").alias("conv_id"), F.struct(F.col("depth").alias("start"), (F.col("upto") - F.col("size")).alias("before")).alias("run"), leaf.alias("leaf"))
    ended = steps.filter("n = depth").select("conv_id", F.struct((F.col("depth") + 1).alias("start"), F.col("upto").alias("before")).alias("run"), F.lit(False).alias("leaf"))
    marks = owned.unionByName(ended).groupBy("conv_id").agg(F.min("run").alias("run"), F.max("leaf").alias("leaf")).select("conv_id", "run.*", F.col("leaf").cast("long").alias("leaf"))
    met = steps.join(scratch.save(marks, "marks"), "conv_id")
    above = F.col("depth") < F.col("start")
    # One that owns nothing has its run begin behind its end.
    child = F.when(above, (F.col("start") == F.col("depth") + 1) & (F.col("start") <= F.col("n"))).otherwise(F.col("n") > F.col("depth")).cast("long")
    saved = F.when(above, F.col("before") - F.col("upto") + F.col("size")).otherwise(0)
    nodes = met.groupBy("class").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.count("*").alias("n_convs"), F.max("n").alias("deepest"),
        F.sum(child).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(saved).cast("long").alias("saved_tokens"),
    )
    nodes = scratch.save(nodes, "nodes")
    parents = classes.select(F.col("class").alias("parent"), F.col("owner").alias("parent_conv_id"))
    named = nodes.join(parents, "parent", "left").join(scratch.save(_end_digests(steps), "ends"), "class", "left")
    shared = named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))
    # The conversations that retired, from the turn behind their last class on.
    alone = nodes.filter("n_convs = 1").groupBy("conv_id").agg(F.max("depth").alias("last"), F.max("deepest").alias("n"))
    rest = alone.filter("last < n")
    starts = rest.withColumn("from", F.explode(F.sequence(F.col("last") + 1, F.col("n"), F.lit(CHAIN))))
    chain = starts.withColumn("depth", F.explode(F.sequence(F.col("from"), F.least("n", F.col("from") + CHAIN - 1))))
    one, end = F.lit(1).cast("long"), F.col("depth") == F.col("n")
    tails = chain.select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(end, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"),
    )
    return shared.unionByName(tails)


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """nodes with the columns of their last turn, from turns (conv_id, depth and any others); the root has none."""
    return nodes.join(turns, ["conv_id", "depth"], "left")
