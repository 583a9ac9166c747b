"""Alignment of long reads to references: minimizer seeds, collinear chains, banded affine extension.

*Seeds.* Of every ``w`` neighbouring words of ``k`` bases the one of the least
hash is a seed, on both strands of a read and on the references. The index is a
table of seeds; reads meet it by a join on the word.

*Chains.* The seeds that a read shares with a reference on one strand are chained:
each follows one before it on both sides, and pays for the difference of the
distances. A chain names the diagonals along which the read lies.

*Extension.* A read is aligned base by base within a band of those diagonals and
``margin`` more on both sides, under gap costs of several pieces (the cheapest
counts), with a bonus for reaching an end of the read. Memory is band times length.

Equal reads are aligned once. Reads that share no seed are looked up by spaced words, every one of them; those
that share none of these either are aligned to every reference in full. So every
read is aligned as far as any of its bases can be.

Pairs of sequences can be aligned end to end too (``pairs``): the band doubles until
no path outside of it can do better.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.functions import seq as S
from strandframe.operators.common import small
from strandframe.scratch import Scratch

K, W, MARGIN = 11, 5, 48
#: Offsets of the spaced words for reads without a shared seed: a run of seven, and one around a changed base.
SPACED = (tuple(range(7)), (0, 1, 2, 3, 4, 5, 6, 8, 9, 10))
#: Chains of a read that score this share of its best are extended; seeds that a chain looks back over; cells worked off at once, and of one row (near caches hold them).
NEAR, LOOK_BACK, CELLS, ROW = 0.6, 64, 1 << 24, 1 << 15
#: Texts, and chains of texts, behind a task; bytes of the alignments of texts up to which they are broadcast to the reads.
READS, HITS = 50_000, 16 << 20
#: Letters whose seeds are found at once, and diagonals besides those from corner to corner that are tried first.
TEXT, CLOSE = 1 << 20, 12
#: A word that a reference holds more often is no seed (low complexity); such reads meet by their other words, or in full.
REPEATS = 64
_LOW = np.int32(-(1 << 28))
_OPS = re.compile(r"(\d+)([MIDNSHPX=])")
_CODE = np.full(256, 4, np.int8)
for _k, _c in enumerate(b"ACGT"):
    _CODE[[_c, _c + 32]] = _k


@dataclass(frozen=True)
class Scores:
    """Costs of an alignment; a gap of n bases costs the least of opening + n * extension."""

    match: int = 2
    mismatch: int = 4
    gaps: tuple[tuple[int, int], ...] = ((6, 2), (24, 1))
    end_bonus: int = 30
    unknown: int = 0

    def gap(self, n: int) -> int:
        return min(o + e * n for o, e in self.gaps) if n else 0

    def within(self, lost: int) -> Scores:
        """The same without the second piece, where it is the cheaper one only for gaps that cost so much or more."""
        (o, e), *more = self.gaps
        needed = self.unknown > self.match or e <= 0 or any(b + c * n < min(o + e * n, lost) for b, c in more for n in range(1, max(1, (lost - o) // e + 1) + 1))
        return self if needed else replace(self, gaps=self.gaps[:1])


def codes(text: str) -> np.ndarray:
    """Bases as 0 to 3, all other letters as 4."""
    return _CODE[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]


def words(bases: np.ndarray, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the bases at some offsets from each place, and the places of those without unknown bases."""
    n = len(bases) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value, known = np.ones(n, np.int64), np.ones(n, bool)
    for o in offsets:
        value = value * 4 + bases[o : o + n]
        known &= bases[o : o + n] < 4
    return value[known], np.flatnonzero(known)


def minimizers(value: np.ndarray, places: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every w neighbouring words the first of the least hash."""
    if len(value) <= w or w == 1:
        return value, places
    hashed = (value * np.int64(0x2545F4914F6CDD1D)) >> 20
    least = np.unique(np.lib.stride_tricks.sliding_window_view(hashed, w).argmin(axis=1) + np.arange(len(value) - w + 1))
    return value[least], places[least]


def seeds(texts: list[str], patterns: tuple[tuple[int, ...], ...], w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, place) of the minimizers of texts. They are laid end to end, with unknown bases between that no word spans."""
    between = "-" * (max(p[-1] for p in patterns) + 1)
    bases = codes(between.join(texts))
    begins = np.cumsum([0] + [len(t) + len(between) for t in texts])[:-1]
    rows, found, at = [], [], []
    for number, offsets in enumerate(patterns):
        value, places = words(bases, offsets)
        row = np.searchsorted(begins, places, "right") - 1
        keep = np.ones(len(value), bool)
        if w > 1 and len(value):
            # As minimizers does for one text; the words of a text with w or fewer all stay.
            keep = np.bincount(row, minlength=len(texts))[row] <= w
            if len(value) > w:
                hashed = (value * np.int64(0x2545F4914F6CDD1D)) >> 20
                within = np.flatnonzero(row[: len(row) - w + 1] == row[w - 1 :])
                keep[np.lib.stride_tricks.sliding_window_view(hashed, w)[within].argmin(axis=1) + within] = True
        rows.append(row[keep])
        found.append(value[keep] * len(patterns) + number)
        at.append((places - begins[row])[keep])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(at)


def _seeds(df: DataFrame, patterns: tuple[tuple[int, ...], ...], w: int) -> DataFrame:
    """(id, strand, word, place) of texts (id, strand, seq)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            lo, room = 0, 0
            for hi, text in enumerate(texts, 1):
                room += len(text)
                if room > TEXT or hi == len(texts):
                    rows, found, at = seeds(texts[lo:hi], patterns, w)
                    take = pa.array(rows + lo)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(found), pa.array(at.astype(np.int32))], ["id", "strand", "word", "place"])
                    lo, room = hi, 0

    return df.select("id", "strand", "seq").mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, strand string, word long, place int")


def chain(r: np.ndarray, q: np.ndarray, size: int) -> tuple[int, int, int]:
    """(score, lowest, highest diagonal) of the best collinear chain of seeds at places r and q."""
    order = np.lexsort((q, r))
    r, q = r[order].astype(np.int64), q[order].astype(np.int64)
    best, came = np.full(len(r), size, np.int64), np.full(len(r), -1)
    for i in range(1, len(r)):
        lo = max(0, i - LOOK_BACK)
        dr, dq = r[i] - r[lo:i], q[i] - q[lo:i]
        apart = np.abs(dr - dq)
        gain = np.minimum(np.minimum(dr, dq), size) - np.where(apart > 0, 1 + apart // 8, 0)
        total = np.where((dr > 0) & (dq > 0), best[lo:i] + gain, _LOW)
        j = int(total.argmax())
        if total[j] > size:
            best[i], came[i] = total[j], lo + j
    i = int(best.argmax())
    score, low, high = int(best[i]), r[i] - q[i], r[i] - q[i]
    while i >= 0:
        low, high = min(low, r[i] - q[i]), max(high, r[i] - q[i])
        i = int(came[i])
    return score, int(low), int(high)


def chains(ends: np.ndarray, r: np.ndarray, q: np.ndarray, size: int) -> list[np.ndarray]:
    """Scores, lowest and highest diagonals of the chains of many lists of seeds. Where all lie on one diagonal they all follow each other."""
    first, n = ends[:-1], np.diff(ends)
    row = np.repeat(np.arange(len(n)), n)
    r, q = r[ends[0] : ends[-1]].astype(np.int64), q[ends[0] : ends[-1]].astype(np.int64)
    order = np.lexsort((r, row))
    diagonal, at = r - q, r[order]
    step = np.zeros(len(r), np.int64)
    step[1:] = np.where(row[1:] == row[:-1], np.minimum(np.diff(at), size), 0)
    starts = first - ends[0]
    score, low, high = size + np.add.reduceat(step, starts), np.minimum.reduceat(diagonal, starts), np.maximum.reduceat(diagonal, starts)
    bent = np.flatnonzero(low != high)
    bent = bent[np.argsort(n[bent], kind="stable")]
    lo = 0
    while lo < len(bent):
        # Lists of similar length side by side; of one alone a step has little to do.
        hi = lo + 1
        while hi < len(bent) and (hi - lo + 1) * min(n[bent[hi]], LOOK_BACK) <= ROW and (hi - lo + 1) * n[bent[hi]] <= CELLS:
            hi += 1
        some = bent[lo:hi]
        score[some], low[some], high[some] = _chained(r, q, starts[some], n[some], size)
        lo = hi
    return [score, low, high]


def _chained(r: np.ndarray, q: np.ndarray, starts: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As chain, of lists from some starts on; seeds are rows, lists are columns."""
    count, longest = len(n), int(n.max())
    row = np.repeat(np.arange(count), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(starts, n) + at
    place = place[np.lexsort((q[place], r[place], row))]
    rs, qs = np.zeros((longest, count), np.int64), np.zeros((longest, count), np.int64)
    rs[at, row], qs[at, row] = r[place], q[place]
    best, came, every = np.full((longest, count), size, np.int64), np.full((longest, count), -1), np.arange(count)
    best[np.arange(longest)[:, None] >= n] = _LOW
    for i in range(1, longest):
        lo = max(0, i - LOOK_BACK)
        dr, dq = rs[i] - rs[lo:i], qs[i] - qs[lo:i]
        apart = np.abs(dr - dq)
        gain = np.minimum(np.minimum(dr, dq), size) - (1 + apart // 8) * (apart > 0)
        total = np.where((dr > 0) & (dq > 0), best[lo:i] + gain, _LOW)
        j = total.argmax(axis=0)
        total = total[j, every]
        longer = (total > size) & (i < n)
        best[i], came[i] = np.where(longer, total, best[i]), np.where(longer, lo + j, -1)
    i = best.argmax(axis=0)
    score, low, high = best[i, every], rs[i, every] - qs[i, every], rs[i, every] - qs[i, every]
    while len(some := np.flatnonzero(i >= 0)):
        diagonal = rs[i[some], some] - qs[i[some], some]
        low[some], high[some] = np.minimum(low[some], diagonal), np.maximum(high[some], diagonal)
        i[some] = came[i[some], some]
    return score, low, high


def _chains(anchors: DataFrame, size: int) -> DataFrame:
    """(id, strand, reference_name, chain, lo, hi) of the seeds shared."""
    names = ["id", "strand", "reference_name", "chain", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            pairs = lists.values
            r, q = (pairs.field(k).to_numpy() for k in (0, 1))
            found = [pa.array(c.astype(np.int32)) for c in chains(ends, r, q, size)] if len(batch) else [pa.array([], pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], names)

    met = anchors.groupBy("id", "strand", "reference_name").agg(F.collect_list(F.struct("rpos", "qpos")).alias("pairs"))
    return met.mapInArrow(run, "id long, strand string, reference_name string, chain int, lo int, hi int")


def _met(both: DataFrame, known: DataFrame, patterns: tuple[tuple[int, ...], ...], w: int) -> DataFrame:
    """Chains of the texts (id, strand, seq) by the seeds that they share with references (reference_name, ref)."""
    index = _seeds(known.select(F.col("reference_name").alias("id"), F.lit("+").alias("strand"), F.col("ref").alias("seq")), patterns, w)
    index = index.select("word", F.col("id").alias("reference_name"), F.col("place").alias("rpos"), F.count("*").over(Window.partitionBy("word", "id")).alias("times")).filter(F.col("times") <= REPEATS)
    texts = _seeds(both, patterns, w).select("id", "strand", "word", F.col("place").alias("qpos"))
    return _chains(texts.join(small(index), "word"), max(len(p) for p in patterns))


def _strands(texts: DataFrame) -> DataFrame:
    sides = F.array(F.struct(F.lit("+").alias("strand"), "seq"), F.struct(F.lit("-").alias("strand"), S.reverse_complement(F.col("seq")).alias("seq")))
    return texts.select("id", F.explode(sides).alias("x")).select("id", "x.*")


def align_reads(reads: DataFrame, refs: DataFrame, scores: Scores = Scores(), k: int = K, w: int = W, margin: int = MARGIN) -> DataFrame:
    """The best alignment of every read, in the alignment schema and with its score; ties go to the first reference, then the forward strand.

    reads: read_id (unique), seq, and quals, tag where known; refs: reference_name, alignment_seq.
    Reads without any aligned base have flag 4, reference ``*`` and no score.
    """
    scratch = Scratch(reads.sparkSession, "aligned")
    known = refs.select("reference_name", F.upper("alignment_seq").alias("ref"))
    # Reads that are equal share an alignment. The rest works on the texts by a number, and reads find theirs by its digest.
    texts = reads.select(F.upper("seq").alias("seq")).distinct().select(F.monotonically_increasing_id().alias("id"), "seq")
    texts = scratch.save(texts).filter("seq <> ''")
    # The work is cut by texts and chains, not by their bytes, which are few.
    parts = lambda rows: max(reads.sparkSession.sparkContext.defaultParallelism, -(-rows // READS))
    dealt = texts.repartition(parts(texts.count()), "id")
    found = scratch.save(_met(_strands(dealt), known, (tuple(range(k)),), w))
    left = scratch.save(texts.join(found.select("id").distinct(), "id", "left_anti"))
    lost = left.count()
    if lost:
        both = _strands(left.repartition(parts(lost), "id"))
        more = scratch.save(_met(both, known, SPACED, 1))
        full = both.join(more.select("id").distinct(), "id", "left_anti").crossJoin(small(known))
        full = full.select("id", "strand", "reference_name", F.lit(1).alias("chain"), (-F.length("seq")).alias("lo"), F.length("ref").alias("hi"))
        found = found.unionByName(more).unionByName(full)
    best = F.max("chain").over(Window.partitionBy("id"))
    near = found.repartition(parts(found.count()), "id").withColumn("best", best).filter(F.col("chain") >= NEAR * F.col("best"))
    # Merged, as a broadcast of the chains would leave their parts to the files of the texts.
    pairs = near.hint("merge").join(texts, "id").join(small(known), "reference_name")
    seq = F.when(F.col("strand") == "-", S.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    done = _extended(pairs.select("id", "strand", "reference_name", "ref", seq.alias("seq"), (F.col("lo") - margin).alias("lo"), (F.col("hi") + margin).alias("hi")), scores)
    row = F.struct((-F.col("score")).alias("s"), "reference_name", "strand", "ref_start", "cigar", "nm", "score")
    hit = done.filter("score > 0").groupBy("id").agg(F.min(row).alias("b")).select("id", "b.*")
    # Saved, so that its size is known: where texts are few, reads need not be dealt out to meet theirs.
    hit = scratch.save(hit.join(texts, "id").select(F.sha2("seq", 256).alias("text"), "reference_name", "strand", "ref_start", "cigar", "nm", "score"))
    out = reads.withColumn("text", F.sha2(F.upper("seq"), 256)).join(small(hit, HITS), "text", "left")
    back = F.col("strand") == "-"
    have = lambda c, kind: F.col(c) if c in reads.columns else F.lit(None).cast(kind)
    quals = have("quals", "array<int>")
    return out.select(
        "read_id", have("tag", "string").alias("tag"), F.coalesce("reference_name", F.lit("*")).alias("reference_name"), F.coalesce("ref_start", F.lit(-1)).alias("ref_start"),
        F.when(F.col("strand").isNull(), 4).when(back, 16).otherwise(0).alias("flag"), F.coalesce("cigar", F.lit("*")).alias("cigar"),
        F.when(back, S.reverse_complement(F.col("seq"))).otherwise(F.upper("seq")).alias("query_seq"), F.when(back, F.reverse(quals)).otherwise(quals).alias("quals"),
        F.lit(None).cast("string").alias("bc"), "nm", "score",
    )


def _extended(pairs: DataFrame, scores: Scores) -> DataFrame:
    """(id, strand, reference_name, score, ref_start, cigar, nm) of pairs with the band of their diagonals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, seqs, lo, hi = (c.to_pylist() for c in batch.columns[3:])
            known = {r: codes(r) for r in set(refs)}
            done = extend([(known[r], codes(q), a, b) for r, q, a, b in zip(refs, seqs, lo, hi, strict=True)], scores)
            out = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int32()), strict=True)] if done else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.string(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *out], ["id", "strand", "reference_name", "score", "ref_start", "cigar", "nm"])

    return pairs.mapInArrow(run, "id long, strand string, reference_name string, score int, ref_start int, cigar string, nm int")


def pairs_aligned(first: list[str], second: list[str], scores: Scores, local: bool) -> list[tuple[int, str, str]]:
    """(score, first, second with gaps) of pairs of texts, end to end or their best parts; letters are compared as they are.

    End to end, a path beyond a band of b diagonals besides those from corner to corner has b gaps on each
    side at least; the band doubles until the score found is as good as any such.
    """
    out: list = [None] * len(first)
    todo, width = list(range(len(first))), 32
    while todo:
        jobs, again = [], []
        for p in todo:
            n, m = len(first[p]), len(second[p])
            wide = max(n, m) + 1 if local else width
            jobs.append((_letters(first[p]), _letters(second[p]), max(min(0, n - m) - wide, -m), min(max(0, n - m) + wide, n)))
        for p, (score, start, cigar, _) in zip(todo, extend(jobs, scores, "local" if local else "global"), strict=True):
            n, m = len(first[p]), len(second[p])
            beyond = scores.match * min(n, m) - scores.gap(width + 1) - scores.gap(width + 1 + abs(n - m))
            if not local and width < max(n, m) and score < beyond:
                again.append(p)
            else:
                out[p] = (max(score, 0) if local else score, *spelled(first[p], second[p], start, cigar))
        todo, width = again, width * 2
    return out


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.int32) + 8


def spelled(ref: str, seq: str, start: int, cigar: str) -> tuple[str, str]:
    """Both sides of an alignment with gaps; clipped bases are left out."""
    a, b, i, j = [], [], start, 0
    for n, op in ((int(n), op) for n, op in _OPS.findall(cigar)):
        if op in "MD":
            a.append(ref[i : i + n])
            i += n
        if op in "MI":
            b.append(seq[j : j + n])
        if op in "MIS":
            j += n
        if op == "I":
            a.append("-" * n)
        if op == "D":
            b.append("-" * n)
    return "".join(a), "".join(b)


def extend(jobs: list[tuple[np.ndarray, np.ndarray, int, int]], scores: Scores, kind: str = "ends") -> list[tuple[int, int, str, int]]:
    """(score, ref_start, cigar, changes) of jobs (ref, query, lowest, highest diagonal), many at once within CELLS.

    kind: ``ends`` clips where that scores more than the bonus for the end, ``local`` gives no
    bonus, ``global`` spans both sides. Score 0 and ``*`` where nothing aligns.
    """
    out: list = [None] * len(jobs)
    if kind == "global":
        for p, job in enumerate(jobs):
            out[p] = _straight(job, scores)
    else:
        # A path beyond these diagonals leaves more than CLOSE bases of the query out, behind a gap or at an end.
        tried = [(r, q, max(lo, min(0, len(r) - len(q)) - CLOSE), min(hi, max(0, len(r) - len(q)) + CLOSE)) for r, q, lo, hi in jobs]
        some = [p for p, (job, close) in enumerate(zip(jobs, tried, strict=True)) if 0 <= 2 * (close[3] - close[2]) <= job[3] - job[2]]
        bonus = scores.end_bonus if kind == "ends" else 0
        lost = scores.match * (CLOSE + 1) + min(bonus, scores.gap(1))
        for p, done in zip(some, _in_parts([tried[p] for p in some], scores.within(lost), kind), strict=True):
            if done[0] > max(0, scores.match * len(jobs[p][1]) + 2 * bonus - lost):
                out[p] = done
    rest = [p for p in range(len(jobs)) if out[p] is None]
    for p, done in zip(rest, _in_parts([jobs[p] for p in rest], scores, kind), strict=True):
        out[p] = done
    return out


def _straight(job: tuple[np.ndarray, np.ndarray, int, int], scores: Scores) -> tuple[int, int, str, int] | None:
    """A global alignment of texts of one length with so few changes that two gaps, which a path with any gap has, cost more."""
    ref, query, lo, hi = job
    if len(ref) != len(query) or not len(ref) or lo > 0 or hi < 0 or scores.unknown > scores.match:
        return None
    changes = int((ref != query).sum())
    if changes * (scores.match + scores.mismatch) >= 2 * scores.gap(1) + scores.match or (ref == 4).any() or (query == 4).any():
        return None
    return scores.match * len(ref) - changes * (scores.match + scores.mismatch), 0, f"{len(ref)}M", changes


def _in_parts(jobs: list, scores: Scores, kind: str) -> list[tuple[int, int, str, int]]:
    """Jobs of similar size together, within CELLS, and ROW in a row."""
    out: list = [None] * len(jobs)
    order = sorted(range(len(jobs)), key=lambda p: (len(jobs[p][1]), jobs[p][3] - jobs[p][2]))
    lo = 0
    while lo < len(order):
        hi, wide = lo, 0
        while hi < len(order):
            wide = max(wide, jobs[order[hi]][3] - jobs[order[hi]][2] + 1)
            if hi > lo and (hi - lo + 1) * wide * max(len(jobs[order[hi]][1]), CELLS // ROW) > CELLS:
                break
            hi += 1
        some = order[lo:hi]
        for p, done in zip(some, _banded([jobs[p] for p in some], scores, kind), strict=True):
            out[p] = done
        lo = hi
    return out


def _banded(jobs: list, scores: Scores, kind: str) -> list[tuple[int, int, str, int]]:
    """Rows are bases of the queries, columns diagonals from the lowest of each job on, and jobs lie side by side; gaps in a row come from running maxima."""
    count, width = len(jobs), max(hi - lo + 1 for _, _, lo, hi in jobs)
    longest = max(len(q) for _, q, _, _ in jobs)
    sizes = np.array([len(q) for _, q, _, _ in jobs])
    lows = np.array([lo for _, _, lo, _ in jobs])
    lengths = np.array([len(r) for r, _, _, _ in jobs])
    if len(scores.gaps) > 2:
        raise ValueError("gap costs have one or two pieces")
    bonus = scores.end_bonus if kind == "ends" else 0
    # Scores of short queries fit narrow numbers, far above what stands for no path.
    most = longest * max(scores.match, scores.mismatch, abs(scores.unknown)) + 2 * bonus + sum(o + e * (width + longest) for o, e in scores.gaps)
    number, none = (np.int16, -(1 << 14)) if most < 1 << 13 else (np.int32, int(_LOW))
    # Each reference as its band sees it: the base of row i, column c is at i + c.
    letters = np.int8 if all(r.dtype == q.dtype == np.int8 for r, q, _, _ in jobs) else np.int32
    refs = np.full((count, longest + width), -1, letters)
    query = np.full((count, longest), -2, letters)
    for p, (r, q, lo, _) in enumerate(jobs):
        a, b = max(0, lo), min(len(r), lo + longest + width)
        if b > a:
            refs[p, a - lo : b - lo] = r[a:b]
        query[p, : len(q)] = q
    refs, query = np.ascontiguousarray(refs.T), np.ascontiguousarray(query.T)
    # What a cell may be worth by a gap, and by its base: nothing beyond the reference. Masks are numbers here, as these are far quicker.
    place, free = np.arange(longest + width)[:, None] + lows, np.iinfo(number).max
    inside = np.where((place >= -1) & (place < lengths), free, none).astype(number)
    based = np.where(refs >= 0, free, none).astype(number)
    open_gap, open_base = (inside == free).all(axis=1), (based == free).all(axis=1)
    unknown = bool((refs == 4).any() or (query == 4).any())
    column = np.arange(width, dtype=number)[:, None]
    h = np.full((width + 1, count), none, number)
    if kind == "global":
        # Before the first row: bases of the reference left out in front.
        ahead = lows + np.arange(width)[:, None]
        costs = np.min([o + e * ahead for o, e in scores.gaps], axis=0)
        h[:width] = np.where((ahead > 0) & (ahead <= lengths), -costs, np.where(ahead == 0, 0, none))
    ups = [np.full((width + 1, count), none, number) for _ in scores.gaps]
    first_row = h.copy()
    came = np.zeros((longest, width, count), np.uint8)
    peak, spot = np.full(count, none if kind == "global" else 0, np.int64), np.full((count, 2), -1)
    left, opened, lowest = (np.full((width, count), none, number) for _ in range(3))
    fresh = lowest if kind == "global" else np.full((width, count), bonus, number)
    right, differ = number(width - 1) - column, number(scores.match + scores.mismatch)
    for i in range(longest):
        base, letter = refs[i : i + width], query[i]
        worth = (base == letter) * differ
        worth -= number(scores.mismatch)
        if unknown:
            worth = np.where((base == 4) | (letter == 4), number(scores.unknown), worth)
        before = h[:width]
        now = np.maximum(before, fresh)
        now += worth
        if not open_base[i : i + width].all():
            np.minimum(now, based[i : i + width], out=now)
        # What a cell comes from, of which each later is better, and whether its gaps go on.
        source, longs, all_in = (before > fresh).view(np.uint8), came[i], open_gap[i : i + width].all()
        for g, (o, e) in enumerate(scores.gaps):
            fewer, longer = h[1:] - number(o + e), ups[g][1:] - number(e)
            longs |= (longer > fewer).view(np.uint8) * np.uint8(8 << g)
            up = np.maximum(fewer, longer, out=ups[g][:width])
            if not all_in:
                np.minimum(up, inside[i : i + width], out=up)
            np.maximum(source, (up > now).view(np.uint8) * np.uint8(2 + g), out=source)
            np.maximum(now, up, out=now)
        straight = now
        for g, (o, e) in enumerate(scores.gaps):
            reach = straight + column * number(e)
            _running(reach)
            np.subtract(reach[:-1], number(o) + number(e) * column[1:], out=left[1:])
            if not all_in:
                np.minimum(left, inside[i : i + width], out=left)
            np.subtract(straight[:-1], number(o + e), out=opened[1:])
            longs |= (left > opened).view(np.uint8) * np.uint8(32 << g)
            np.maximum(source, (left > now).view(np.uint8) * np.uint8(4 + g), out=source)
            now = np.maximum(now, left)
        now = np.maximum(now, lowest, out=h[:width])
        longs |= source
        if i == 0 and kind != "global":
            fresh = np.zeros((width, count), number)
        if kind == "global":
            mine = np.flatnonzero(sizes == i + 1)
            at = lengths[mine] - 1 - i - lows[mine]
            peak[mine], spot[mine, 0], spot[mine, 1] = now[at, mine], i, at
        else:
            last = sizes == i + 1
            valued = now + np.where(last, number(bonus), number(0)) if bonus and last.any() else now
            top = valued.max(axis=0)
            better = (top > peak) & (i < sizes)
            if better.any():
                c = width - 1 - ((valued == top) * right).max(axis=0)
                peak[better], spot[better, 0], spot[better, 1] = top[better], i, c[better]
    out = _runs(jobs, peak, spot, came, refs, query) if kind != "global" else [None] * count
    return [done or _traced(jobs[p], int(peak[p]), int(spot[p, 0]), int(spot[p, 1]), came[:, :, p], first_row[:, p], scores, kind) for p, done in enumerate(out)]


def _running(x: np.ndarray) -> None:
    """Maxima down to each row, in place."""
    if x.shape[1] > 4 * len(x):
        for c in range(1, len(x)):
            np.maximum(x[c], x[c - 1], out=x[c])
    else:
        step = 1
        while step < len(x):
            np.maximum(x[step:], x[:-step], out=x[step:])
            step *= 2


def _runs(jobs: list, peak: np.ndarray, spot: np.ndarray, came: np.ndarray, refs: np.ndarray, query: np.ndarray) -> list[tuple[int, int, str, int] | None]:
    """Alignments that run along one diagonal; None for the others."""
    rows, every = np.arange(len(came))[:, None], np.arange(len(jobs))
    end, c = spot[:, 0], spot[:, 1]
    kinds = came[rows, c, every] & 7
    begin = np.where((kinds != 1) & (rows <= end), rows, -1).max(axis=0)
    plain = (end >= 0) & ((begin < 0) | (kinds[begin, every] == 0))
    begin = np.maximum(begin, 0)
    changes = ((refs[rows + c, every] != query) & (rows >= begin) & (rows <= end)).sum(axis=0)
    out: list = [None] * len(jobs)
    for p, score, a, b, n, at in zip(every[plain].tolist(), *(x[plain].tolist() for x in (peak, begin, end, changes, c)), strict=True):
        behind = len(jobs[p][1]) - 1 - b
        out[p] = score, a + jobs[p][2] + at, (f"{a}S" if a else "") + f"{b - a + 1}M" + (f"{behind}S" if behind else ""), n
    return out


def _traced(job, peak: int, i: int, c: int, came: np.ndarray, first_row: np.ndarray, scores: Scores, kind: str) -> tuple[int, int, str, int]:
    ref, query, lo, _ = job
    if kind == "global" and not len(query):
        return -scores.gap(len(ref)), 0, f"{len(ref)}D" if len(ref) else "", len(ref)
    if i < 0:
        return 0, -1, "*", 0
    steps, changes, state = [(len(query) - 1 - i, "S")], 0, 0
    while True:
        if i < 0:
            # Before the first base of the query: what is left of the reference.
            if kind == "global" and lo + c > 0:
                steps.append((lo + c, "D"))
                changes += lo + c
            break
        j, code = i + lo + c, int(came[i, c])
        if state == 0:
            state = code & 7
            if state in (0, 1):
                # A run along the diagonal, up to where it began or a gap ended.
                run = came[i::-1, c] & 7
                other = np.flatnonzero(run != 1)
                n = int(other[0]) if len(other) else i + 1
                begun = n <= i and int(run[n]) == 0
                n += begun
                changes += int((ref[j - n + 1 : j + 1] != query[i - n + 1 : i + 1]).sum())
                steps.append((n, "M"))
                i -= n
                if begun:
                    break
                state = 0
            continue
        changes += 1
        if state in (2, 3):
            steps.append((1, "I"))
            longer = code & (8 << (state - 2))
            i, c = i - 1, c + 1
        else:
            steps.append((1, "D"))
            longer = code & (32 << (state - 4))
            c -= 1
            # A deletion comes from what the row had without deletions.
            if not longer:
                state = int(came[i, c]) & 7
                if state >= 4:
                    raise AssertionError("a deletion begins at a deletion")
                if state in (0, 1):
                    state = 0
                continue
        state = state if longer else 0
    start = 0 if kind == "global" else i + 1 + lo + c
    steps.append((i + 1, "S"))
    merged: list[list] = []
    for n, op in reversed(steps):
        if n and merged and merged[-1][1] == op:
            merged[-1][0] += n
        elif n:
            merged.append([n, op])
    return peak, start, "".join(f"{n}{op}" for n, op in merged), changes
