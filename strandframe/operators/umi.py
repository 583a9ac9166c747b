"""Unique molecular identifiers: extraction, clustering, down-sampling, consensus."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.functions import seq as S
from strandframe.operators.common import distribution, fill_both_ways, ranked
from strandframe.operators.consensus import majority
from strandframe.scratch import Scratch


def extract(reads: DataFrame, contexts: list[str]) -> DataFrame:
    """reads (gapped_ref, query) with umi, success, failure and a flag per context.

    The barcodes of all contexts are concatenated; one that fails leaves no UMI.
    """
    out, flags = reads, []
    for k, context in enumerate(contexts, 1):
        out = out.withColumn(f"__at{k}", S.find_context(F.col("gapped_ref"), context))
        out = out.withColumn(f"umi_{k}_failure", F.col(f"__at{k}.reason").isNotNull().cast("long"))
        flags.append(F.col(f"umi_{k}_failure"))
    parts = [F.expr(f"substring(query, __at{k}.start + 1, __at{k}.stop - __at{k}.start)") for k in range(1, len(contexts) + 1)]
    failed = sum(flags[1:], flags[0]) > 0
    out = out.withColumn("umi", F.when(failed, "").otherwise(F.concat(*parts)))
    out = out.withColumn("success", (~failed).cast("long")).withColumn("failure", failed.cast("long"))
    return out.drop(*(f"__at{k}" for k in range(1, len(contexts) + 1)))


def extract_summary(log: DataFrame, contexts: int, by: tuple[str, ...] = ("tag", "reference_name")) -> DataFrame:
    return log.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("success", "failure", *(f"umi_{k}_failure" for k in range(1, contexts + 1)))))


def _masked(umis: DataFrame, mismatches: int) -> DataFrame:
    """umis by key: their text with each choice of that many letters masked."""
    rows = umis.select("reference_name", "umi", "umi_count", F.length("umi").alias("n"), F.col("umi").alias("key"), F.lit(0).alias("last"))
    for _ in range(mismatches):
        # A text shorter than the number of masks is masked as far as it goes.
        places = F.sequence(F.col("last") + 1, F.greatest(F.col("n"), F.col("last") + 1))
        rows = rows.withColumn("at", F.explode(places)).withColumn("last", F.col("at"))
        rows = rows.withColumn("key", F.overlay("key", F.lit("."), F.col("at"))).drop("at")
    return rows.drop("last")


def _segments(umis: DataFrame, mismatches: int) -> DataFrame:
    """umis by key: each of mismatches + 1 equal segments with its number."""
    cut = mismatches + 1
    step = F.greatest(F.lit(1), F.floor(F.length("umi") / cut)).cast("int")
    part = lambda k: F.substring(F.col("umi"), F.lit(k) * step + 1, F.when(F.lit(k == mismatches), F.length("umi")).otherwise(step))
    keys = F.array(*(F.concat(F.lit(f"{k}:"), part(k)) for k in range(cut)))
    return umis.select("reference_name", "umi", "umi_count", F.length("umi").alias("n"), F.explode(keys).alias("key"))


def cluster(umis: DataFrame, mismatches: int = 1) -> DataFrame:
    """(reference_name, umi, umi_count, final_umi, final_umi_count, unique_id).

    umis: reference_name, umi, umi_count. Directional adjacency: a UMI joins a
    neighbour within mismatches that has at least twice its reads minus one;
    the most frequent neighbour is taken, the first of equals. Following these
    choices upward ends at the UMI that names the group. With one or two
    mismatches, neighbours are UMIs that are equal but for that many masked
    letters, so only true neighbours meet; with more they are found by a join on
    mismatches + 1 equal segments. The upward walk doubles its steps each round
    and writes each round, so no group has to fit into one task.
    """
    keyed = _masked(umis, mismatches) if 1 <= mismatches <= 2 else _segments(umis, mismatches)
    other = keyed.select("reference_name", "n", "key", F.col("umi").alias("up"), F.col("umi_count").alias("up_count"))
    more = (F.col("up_count") > F.col("umi_count")) | ((F.col("up_count") == F.col("umi_count")) & (F.col("up") < F.col("umi")))
    near = keyed.join(other, ["reference_name", "n", "key"]).filter((F.col("up_count") >= 2 * F.col("umi_count") - 1) & more)
    if mismatches > 2:
        near = near.filter(S.hamming(F.col("umi"), F.col("up")) <= mismatches)
    parent = near.groupBy("reference_name", "umi").agg(F.min(F.struct((-F.col("up_count")).alias("c"), F.col("up"))).alias("m")).select("reference_name", "umi", F.col("m.up").alias("up"))
    scratch = Scratch(umis.sparkSession, "umis")
    root = scratch.save(umis.join(parent, ["reference_name", "umi"], "left").select("reference_name", "umi", "umi_count", F.coalesce("up", "umi").alias("final_umi")))
    # A parent has more reads, or as many and comes first: the walk cannot turn in circles.
    for _ in range(64):
        hop = root.select("reference_name", F.col("umi").alias("final_umi"), F.col("final_umi").alias("next"))
        moved = root.join(hop, ["reference_name", "final_umi"]).select("reference_name", "umi", "umi_count", F.col("next").alias("new"), (F.col("next") != F.col("final_umi")).alias("moves"))
        moved = scratch.save(moved)
        scratch.drop(1)
        root = moved.select("reference_name", "umi", "umi_count", F.col("new").alias("final_umi"))
        if moved.filter("moves").isEmpty():
            break
    else:
        raise RuntimeError("the walk to the groups' names did not end")
    group = Window.partitionBy("reference_name", "final_umi")
    out = root.withColumn("final_umi_count", F.sum("umi_count").over(group))
    ids = out.select("reference_name", "final_umi", "final_umi_count").distinct()
    ids = ranked(ids, ["reference_name"], [-F.col("final_umi_count"), F.substring("final_umi", 1, 4)], [F.col("final_umi")], "unique_id").withColumn("unique_id", F.col("unique_id") - 1)
    return out.join(ids.drop("final_umi_count"), ["reference_name", "final_umi"])


def group_sizes(groups: DataFrame, by: tuple[str, ...] = ("reference_name",)) -> DataFrame:
    """Distribution of reads per UMI group; no group has 0."""
    each = groups.select(*by, "unique_id", "final_umi_count").distinct()
    return distribution(each, "final_umi_count", list(by)).filter("x >= 1")


def downsample(reads: DataFrame, minimum: int, maximum: int, by: tuple[str, ...] = ("reference_name", "unique_id"), batches: int = 1) -> DataFrame:
    """Groups of minimum reads or more, cut to maximum reads with strands in balance.

    Reads have strand (+ or -) and quality; the best of each strand stay.
    """
    whole = Window.partitionBy(*by)
    plus, minus = F.sum((F.col("strand") == "+").cast("long")).over(whole), F.sum((F.col("strand") == "-").cast("long")).over(whole)
    rows = reads.withColumn("__p", plus).withColumn("__m", minus).filter(F.col("__p") + F.col("__m") >= minimum)
    half = F.least(F.col("__p"), F.lit(maximum // 2))
    km = F.least(F.col("__m"), F.lit(maximum) - half)
    kp = F.when(half + km < maximum, F.least(F.col("__p"), F.lit(maximum) - km)).otherwise(half)
    rank = F.row_number().over(Window.partitionBy(*by, "strand").orderBy(F.desc("quality"), "read_id"))
    kept = rows.withColumn("__r", rank).filter(F.col("__r") <= F.when(F.col("strand") == "+", kp).otherwise(km)).drop("__p", "__m", "__r")
    kept = kept.withColumn("batch", F.col("unique_id") % batches)
    return kept.withColumn("read_name", F.concat(F.lit("UMI-"), F.col("unique_id").cast("string"), F.lit("|ref-"), F.col("reference_name"), F.lit("|"), F.col("read_id")))


def groups_log(log: DataFrame) -> DataFrame:
    """read_id, umi, reference_name, counts and id, gaps of a group filled within it."""
    out = log
    for c in ("umi_count", "final_umi_count"):
        out = fill_both_ways(out, ["reference_name", "unique_id"], "read_id", c)
    return out.orderBy(F.desc("final_umi_count"), "unique_id", F.desc("umi_count"), "umi", "read_id")


def consensus(reads: DataFrame, by: tuple[str, ...] = ("reference_name", "unique_id")) -> DataFrame:
    """Majority vote per reference position of gapped queries.

    Ties go to the first letter of A, T, G, C, gap, N. Gaps that win are left out. Reads with
    insertions, and votes by quality: ``consensus.molecules``.
    """
    return majority(reads, list(by))


def rca_filter(names: DataFrame, references: DataFrame, least: int, most: int, col: str = "read_name") -> DataFrame:
    """Log of concatemer reads: repeats within bounds and a subread as long as a reference, 20 % more or less."""
    f = S.parse_rca_name(F.col(col))
    lengths = references.agg(F.min(F.length("alignment_seq")).alias("__lo"), F.max(F.length("alignment_seq")).alias("__hi"))
    rows = names.select(f.alias("f")).select("f.*").crossJoin(F.broadcast(lengths))
    ok = F.col("number_of_complete_repeats").between(least - 2, most - 2) & F.col("subread_length").between(0.8 * F.col("__lo"), 1.2 * F.col("__hi"))
    out = rows.withColumn("read_length/subread_length", F.col("original_read_length") / F.col("subread_length"))
    return out.withColumn("pass/fail", F.when(ok, "pass").otherwise("fail")).drop("__lo", "__hi")


def merge_pairs(forward: DataFrame, backward: DataFrame, overlap: int = 10, mismatch: float = 0.1) -> DataFrame:
    """Read pairs merged at their longest overlap within the mismatch rate; a substitute for a merging tool.

    Both sides: read_id, seq, quals. In the overlap the base of higher quality wins.
    """
    both = forward.select("read_id", F.col("seq").alias("a"), F.col("quals").alias("qa")).join(
        backward.select("read_id", F.col("seq").alias("b"), F.col("quals").alias("qb")), "read_id"
    )
    turn = str.maketrans(S.IUPAC, S.COMPLEMENTS)

    def run(frames):
        for pdf in frames:
            pdf["b"] = [b.upper().translate(turn)[::-1] for b in pdf["b"]]
            parts = [_overlapped(part, overlap, mismatch) for _, part in pdf.groupby([pdf["a"].str.len(), pdf["b"].str.len()])]
            yield pd.concat(parts) if parts else pd.DataFrame(columns=["read_id", "seq", "quals", "overlap"])

    return both.mapInPandas(run, "read_id string, seq string, quals array<int>, overlap int")


def _overlapped(pairs: pd.DataFrame, overlap: int, mismatch: float) -> pd.DataFrame:
    """Merged pairs of one length each; a longer overlap is tried before a shorter one, for all pairs at once."""
    a, b = (np.array([list(t) for t in pairs[c]], dtype="U1").reshape(len(pairs), -1) for c in "ab")
    p, q = np.stack(pairs["qa"].to_numpy()), np.stack(pairs["qb"].to_numpy())[:, ::-1]
    found = np.zeros(len(pairs), np.int64)
    for n in range(min(a.shape[1], b.shape[1]), overlap - 1, -1):
        left = np.flatnonzero(found == 0)
        if not len(left):
            break
        apart = (a[left, a.shape[1] - n :] != b[left, :n]).sum(axis=1)
        found[left[apart <= mismatch * n]] = n
    out = []
    for n in np.unique(found[found > 0]).tolist():
        rows = np.flatnonzero(found == n)
        head, x, y, tail = a[rows, : a.shape[1] - n], a[rows, a.shape[1] - n :], b[rows, :n], b[rows, n:]
        px, py = p[rows, a.shape[1] - n :], q[rows, :n]
        seq = np.concatenate([head, np.where(px >= py, x, y), tail], axis=1)
        quals = np.concatenate([p[rows, : a.shape[1] - n], np.maximum(px, py), q[rows, n:]], axis=1)
        names = pairs["read_id"].to_numpy()[rows]
        out.append(pd.DataFrame({"read_id": names, "seq": ["".join(t) for t in seq], "quals": [[int(v) for v in t] for t in quals], "overlap": n}))
    return pd.concat(out) if out else pd.DataFrame(columns=["read_id", "seq", "quals", "overlap"])
