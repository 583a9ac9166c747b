"""Connected components of an edge table by alternating star contraction.

Large-star hangs every larger neighbour of a node on the smallest node around
it, small-star every smaller neighbour; the two alternate until every edge
joins a member to the smallest node of its component. Only minima are
aggregated and joined back: no neighbour list is gathered in a task. The minima
are written before they are joined, so that few are sent to all tasks, and many
meet the edges in a join of two plain shuffles, whose hot nodes can be split at run
time (an aggregate in the same stage would forbid that).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.llm._store import Scratch


def _star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a > b) with each a hung on the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a > b")
    large = scratch.save(large.distinct(), "large")
    down = scratch.save(large.groupBy("a").agg(F.min("b").alias("m")), "down")
    out = (
        large.join(down, "a")
        .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        .select("e.a", "e.b").filter("a > b").distinct()
    )
    out = scratch.save(out, "stars")
    scratch.drop(edges, least, large, down)
    return out


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in an edge (a, b); component is the smallest id reachable.

    Self-loops and nulls are left out. Raises if ``rounds`` contractions do not
    converge, which takes a component of far more than 2**rounds nodes.
    """
    now = scratch.save(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges"
    )
    mark = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            root = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(root)
        mark = tuple(seen)
        now = _star(now, scratch)
    raise RuntimeError(f"components did not converge in {rounds} rounds")
