"""Consensus of groups of reads that bear insertions and deletions, and of the repeats inside concatemer reads.

*Votes.* A read that is aligned to its group's draft votes, by quality, for a letter or a gap
at every place of the draft, and for letters inserted behind it. Votes add up: a
task sums those of the reads it meets, and only these sums, one row per group
and task, are shuffled and added. So a group of any size is never gathered.

*Rounds.* The first draft is the reference, or one of the reads. Each round aligns the
reads to the draft of the round before and votes anew, until no draft changes. Groups of
few letters are brought together once and go through all rounds in one task.

*Concatemers.* Words that recur in a read at one distance name the length of its
unit; cuts follow from one unit to the next by the recurring words next to them, so
insertions and deletions do not add up. The units between the cuts vote.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandframe.functions import seq as S
from strandframe.operators.align import _CODE, _OPS, TEXT, Scores, codes, extend, words
from strandframe.scratch import Scratch

LETTERS = S.NT_ALPHABET
_PLACE = np.full(256, LETTERS.index("N"), np.int64)
for _k, _c in enumerate(LETTERS):
    _PLACE[[ord(_c), ord(_c.lower())]] = _k
_GAP = LETTERS.index("-")
#: Cells of sums that a task holds before it hands them on; inserted letters that are told apart behind one place.
HELD, INSERTED = 1 << 22, 1 << 16
SCORES, MARGIN, ROUNDS = Scores(), 48, 4
#: Letters of a group that one task settles, and of the groups behind a task; what a row weighs besides its letters.
TOGETHER, PART, ROW = TEXT, 1 << 27, 64
#: Letters of groups that a task brings together before it works them off, at most so many at once.
HOLD, SOME = TEXT, 2 * TEXT
#: Length of the words that find a unit, the shortest unit, and by how much its copies may differ in length.
WORD, SHORTEST, SLACK = 8, 20, 0.15


class Pile:
    """Votes of a group: letters by place, and letters inserted behind places (from -1 on)."""

    def __init__(self) -> None:
        self.reads, self.votes, self.extra = 0, np.zeros((0, len(LETTERS)), np.int64), {}

    def room(self, n: int) -> None:
        if n > len(self.votes):
            more = np.zeros((max(n, 2 * len(self.votes)) if len(self.votes) else n, len(LETTERS)), np.int64)
            more[: len(self.votes)] = self.votes
            self.votes = more

    def gapped(self, text: str) -> None:
        """A read spelled along the draft."""
        self.reads += 1
        letters = _PLACE[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
        self.room(len(letters))
        self.votes[np.arange(len(letters)), letters] += 1

    def aligned(self, seq: str, quals: np.ndarray | None, start: int, cigar: str) -> None:
        """A read by its alignment; without qualities every base has one vote."""
        self.reads += 1
        letters = _PLACE[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
        weight = np.ones(len(letters), np.int64) if quals is None else np.maximum(quals, 1).astype(np.int64)
        i, j = start, 0
        for size, op in _OPS.findall(cigar):
            n = int(size)
            if op in "M=X":
                self.room(i + n)
                self.votes[np.arange(i, i + n), letters[j : j + n]] += weight[j : j + n]
                i, j = i + n, j + n
            elif op == "D":
                self.room(i + n)
                around = weight[max(0, j - 1) : j + 1]
                self.votes[i : i + n, _GAP] += int(around.mean()) if len(around) else 1
                i += n
            elif op == "I":
                for k in range(min(n, INSERTED)):
                    self._insert(i * INSERTED + k)[letters[j + k]] += weight[j + k]
                j += n
            elif op == "S":
                j += n

    def _insert(self, key: int) -> np.ndarray:
        """Votes for the k-th letter behind place i - 1, under i * INSERTED + k."""
        if key not in self.extra:
            self.extra[key] = np.zeros(len(LETTERS), np.int64)
        return self.extra[key]

    def add(self, reads: int, votes: np.ndarray, keys: np.ndarray, extra: np.ndarray) -> None:
        self.reads += reads
        votes = votes.reshape(-1, len(LETTERS))
        if len(self.votes):
            self.room(len(votes))
            self.votes[: len(votes)] += votes
        else:
            self.votes = votes.copy()
        for key, v in zip(keys.tolist(), extra.reshape(-1, len(LETTERS)), strict=True):
            self._insert(key)[:] += v

    def called(self) -> str:
        """The letters with most votes, the first of the alphabet if equal; inserted ones where they outweigh their absence."""
        return called([self])[0]

    def _with_inserted(self, text: str, total: np.ndarray) -> str:
        out, done = [], 0
        for key in sorted(k for k in self.extra if k % INSERTED == 0):
            at = key // INSERTED
            said = int(total[min(max(at - 1, 0), len(total) - 1)]) if len(total) else 0
            more = []
            while key in self.extra and 2 * int(self.extra[key].sum()) > said:
                more.append(LETTERS[int(self.extra[key].argmax())])
                key += 1
            if more:
                out += [text[done:at], "".join(more)]
                done = at
        return "".join([*out, text[done:]])


def called(piles: list[Pile]) -> list[str]:
    """What Pile.called says of each of many piles."""
    if not piles:
        return []
    flat, out, lo = np.concatenate([p.votes for p in piles]), [], 0
    total = flat.sum(axis=1)
    text = np.frombuffer(LETTERS.encode(), np.uint8)[np.where(total > 0, flat.argmax(axis=1), _GAP)].tobytes().decode()
    for p in piles:
        hi = lo + len(p.votes)
        out.append((p._with_inserted(text[lo:hi], total[lo:hi]) if p.extra else text[lo:hi]).replace("-", ""))
        lo = hi
    return out


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
    """All letters of texts in a row, and where each text ends and the next begins; None where letters are not single bytes."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    letters = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(ends, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return None if (letters[ends[0] : ends[-1]] > 127).any() else (letters, ends)


def _parts(sizes: np.ndarray, letters: int | None = None) -> Iterator[np.ndarray]:
    """Numbers of rows, so many at once as have TEXT letters (or others), or one."""
    step = (np.cumsum(sizes) // (letters or TEXT)).astype(np.int64)
    yield from np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(step)) + 1) if len(sizes) else ()


def _spans(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every place of rows that begin somewhere."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)


@lru_cache(1 << 16)
def _path(cigar: str) -> tuple[tuple, tuple, int]:
    """Runs (place, base, size) of an alignment, its gaps (operation, place, base, size), and the bases it needs; places count from its start."""
    runs, gaps, i, j = [], [], 0, 0
    for size, op in _OPS.findall(cigar):
        n = int(size)
        if op in "M=X":
            runs.append((i, j, n))
            i, j = i + n, j + n
        elif op == "D":
            gaps.append((op, i, j, n))
            i += n
        elif op in "IS":
            if op == "I":
                gaps.append((op, i, j, n))
            j += n
    return tuple(runs), tuple(gaps), j


def vote(piles: list[Pile], texts: pa.Array, quals: list[np.ndarray | None], places: list[tuple[int, str] | None]) -> None:
    """Votes of reads with their (start, cigar), as Pile.aligned counts them; None has no vote. Runs without gaps are counted together."""
    flat = _flat(texts)
    size = np.diff(flat[1]).tolist() if flat else []
    rows, spans, gapped = [], [], []
    for k, place in enumerate(places):
        if not place:
            continue
        runs, gaps, need = _path(place[1])
        if not flat or need > size[k]:
            piles[k].aligned(texts[k].as_py(), quals[k], *place)
            continue
        piles[k].reads += 1
        for i, j, n in runs:
            rows.append(k)
            spans.append((place[0] + i, j, n))
        if gaps:
            gapped.append((k, place[0], gaps))
    if rows:
        _count(piles, flat, quals, rows, *np.array(spans, np.int64).T)
    for k, start, gaps in gapped:
        weight = None if quals[k] is None else np.maximum(quals[k], 1)
        for op, i, j, n in gaps:
            i += start
            if op == "D":
                piles[k].room(i + n)
                around = () if weight is None else weight[max(0, j - 1) : j + 1]
                piles[k].votes[i : i + n, _GAP] += int(around.mean()) if len(around) else 1
                continue
            begin = int(flat[1][k]) + j
            for m, letter in enumerate(_PLACE[flat[0][begin : begin + min(n, INSERTED)]].tolist()):
                piles[k]._insert(i * INSERTED + m)[letter] += 1 if weight is None else weight[j + m]


def _count(piles: list[Pile], flat: tuple[np.ndarray, np.ndarray], quals: list[np.ndarray | None], rows: list[int], at: np.ndarray, begin: np.ndarray, n: np.ndarray) -> None:
    """Votes of runs of reads (rows), from a place and a base on."""
    letters, ends = flat
    for part in _parts(n):
        mine = [rows[k] for k in part.tolist()]
        number: dict[int, int] = {}
        which = np.array([number.setdefault(id(piles[k]), len(number)) for k in mine])
        reach = np.zeros(len(number), np.int64)
        np.maximum.at(reach, which, (at + n)[part])
        base = np.cumsum(reach) - reach
        row, place = _spans(ends[mine] + begin[part], n[part])
        cell = place + (base[which] + at[part] - ends[mine] - begin[part])[row]
        weight = None
        if any(quals[k] is not None for k in mine):
            weight = np.concatenate([np.ones(n[p]) if quals[k] is None else np.maximum(quals[k][begin[p] : begin[p] + n[p]], 1) for k, p in zip(mine, part, strict=True)])
        sums = np.bincount(cell * len(LETTERS) + _PLACE[letters[place]], weight, int(reach.sum()) * len(LETTERS)).astype(np.int64, copy=False).reshape(-1, len(LETTERS))
        found = {id(piles[k]): piles[k] for k in mine}
        for p, lo, size in zip(map(found.get, number), base.tolist(), reach.tolist(), strict=True):
            if len(p.votes):
                p.room(size)
                p.votes[:size] += sums[lo : lo + size]
            else:
                p.votes = sums[lo : lo + size]


def _tallied(group: np.ndarray, count: int, letters: np.ndarray, weight: np.ndarray | None, at: np.ndarray, n: np.ndarray, begin: np.ndarray, code: np.ndarray, cigars: list[str]) -> tuple[list[str], np.ndarray]:
    """What count groups say, and by how many reads: what vote and called give, for reads that lie in one array of letters, from a place on, n each.

    Each read has a first place on its draft and the number of its alignment; those of number -1 have no vote.
    """
    paths = [_path(c) for c in cigars]
    rows = np.flatnonzero(code >= 0)
    of = code[rows]

    def rolled(parts: list[list[tuple]], width: int) -> tuple[np.ndarray, ...]:
        """Pieces of the alignments of all rows: the row of each, then its columns."""
        number = np.array([len(x) for x in parts], np.int64)
        table = np.array([x for part in parts for x in part], np.int64).reshape(-1, width)
        which, piece = _spans((np.cumsum(number) - number)[of], number[of])
        return rows[which], *table[piece].T

    mine, place, base, size = rolled([p[0] for p in paths], 3)
    place = begin[mine] + place
    cut, lost, before, gone = rolled([[x[1:] for x in p[1] if x[0] == "D"] for p in paths], 3)
    lost = begin[cut] + lost
    put, there, first, more = rolled([[x[1:] for x in p[1] if x[0] == "I"] for p in paths], 3)
    more = np.minimum(more, INSERTED)
    if (base + size > n[mine]).any() or (first + more > n[put]).any():
        raise ValueError("an alignment names more bases than its read has")
    reach = np.zeros(count, np.int64)
    np.maximum.at(reach, group[mine], place + size)
    np.maximum.at(reach, group[cut], lost + gone)
    ends = np.cumsum(reach)
    start, total = ends - reach, int(reach.sum())
    row, cell = _spans(start[group[mine]] + place, size)
    where = cell + (at[mine] + base - start[group[mine]] - place)[row]
    votes = np.bincount(cell + total * _PLACE[letters[where]], None if weight is None else weight[where], len(LETTERS) * total).astype(np.int64, copy=False).reshape(len(LETTERS), total)
    if len(cut):
        row, cell = _spans(start[group[cut]] + lost, gone)
        worth = np.ones(len(cut), np.int64)
        if weight is not None:
            # The mean of the bases beside the gap.
            some = n[cut] > 0
            left, right = np.maximum(before - 1, 0)[some], np.minimum(before, n[cut] - 1)[some]
            worth[some] = (weight[at[cut[some]] + left] + weight[at[cut[some]] + right]) // 2
        votes[_GAP] += np.bincount(cell, worth[row], total).astype(np.int64)
    most, best = votes[0], np.zeros(total, np.int64)
    for k in range(1, len(LETTERS)):
        best[votes[k] > most] = k
        most = np.maximum(most, votes[k])
    best[most == 0] = _GAP
    kept = np.concatenate([[0], np.cumsum(best != _GAP)])
    text, lo, hi = np.frombuffer(LETTERS.encode(), np.uint8)[best], kept[start].tolist(), kept[ends].tolist()
    said = text[best != _GAP].tobytes().decode()
    out = [said[a:b] for a, b in zip(lo, hi, strict=True)]
    if len(put):
        row, k = _spans(np.zeros(len(put), np.int64), more)
        key, who = (begin[put] + there)[row] * INSERTED + k, group[put][row]
        letter = _PLACE[letters[(at[put] + first)[row] + k]]
        order = np.lexsort((key, who))
        new = np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(who[order]) != 0)])
        worth = None if weight is None else weight[(at[put] + first)[row] + k][order]
        extra = np.bincount((np.cumsum(new) - 1) * len(LETTERS) + letter[order], worth, int(new.sum()) * len(LETTERS)).astype(np.int64).reshape(-1, len(LETTERS))
        key, who = key[order][new], who[order][new]
        # Groups where an inserted letter outweighs its absence are spelled one by one.
        beside = np.concatenate([votes.sum(axis=0), [0]])[np.where(reach[who] > 0, start[who] + np.clip(key // INSERTED - 1, 0, np.maximum(reach[who] - 1, 0)), total)]
        for g in np.unique(who[(key % INSERTED == 0) & (2 * extra.sum(axis=1) > beside)]).tolist():
            a, b = np.searchsorted(who, [g, g + 1])
            pile = Pile()
            pile.extra = dict(zip(key[a:b].tolist(), extra[a:b], strict=True))
            whole = slice(int(start[g]), int(ends[g]))
            out[g] = pile._with_inserted(text[whole].tobytes().decode(), votes[:, whole].sum(axis=0)).replace("-", "")
    return out, np.bincount(group[rows], minlength=count)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))


def _keys_schema(df: DataFrame, by: list[str]) -> list[T.StructField]:
    return [df.schema[c] for c in by]


def _voted(df: DataFrame, by: list[str], fill: Callable[[list[Pile], list[list]], None]) -> DataFrame:
    """(by, reads, consensus) of rows whose columns behind by are what fill gives to their piles."""
    fields = _keys_schema(df, by)
    sums = [T.StructField("reads", T.LongType()), T.StructField("votes", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("extra", T.ArrayType(T.LongType()))]
    n = len(by)

    def out(piles: dict[tuple, Pile], types: list[pa.DataType], last: bool) -> Iterator[pa.RecordBatch]:
        items = list(piles.items())
        for lo in range(0, len(items), 512):
            part = items[lo : lo + 512]
            columns = [pa.array([key[k] for key, _ in part], types[k]) for k in range(n)]
            columns.append(pa.array([p.reads for _, p in part], pa.int64()))
            if last:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(called([p for _, p in part]), pa.string())], [*by, "reads", "consensus"])
                continue
            used = [p.votes[: int(np.flatnonzero(p.votes.any(axis=1)).max(initial=-1)) + 1].ravel() for _, p in part]
            none = np.zeros(0, np.int64)
            keys = [np.array(list(p.extra), np.int64) if p.extra else none for _, p in part]
            columns += [_lists(used), _lists(keys), _lists([np.concatenate(list(p.extra.values())) if p.extra else none for _, p in part])]
            yield pa.RecordBatch.from_arrays(columns, [*by, "reads", "votes", "keys", "extra"])

    def pile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piles, types = {}, []
        for batch in batches:
            types = [c.type for c in batch.columns[:n]]
            mine = []
            for key in zip(*(c.to_pylist() for c in batch.columns[:n]), strict=True):
                if key not in piles:
                    piles[key] = Pile()
                mine.append(piles[key])
            fill(mine, batch.columns[n:])
            if sum(p.votes.size + len(LETTERS) * len(p.extra) for p in piles.values()) > HELD:
                yield from out(piles, types, False)
                piles = {}
        if piles:
            yield from out(piles, types, False)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, piles, types = None, {}, []
        for batch in batches:
            types = [c.type for c in batch.columns[:n]]
            reads = batch.column(n).to_pylist()
            lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns[n + 1 :]]
            for row, key in enumerate(zip(*(c.to_pylist() for c in batch.columns[:n]), strict=True)):
                if key != now and len(piles) >= 256:
                    yield from out(piles, types, True)
                    piles = {}
                now = key
                if key not in piles:
                    piles[key] = Pile()
                piles[key].add(reads[row], *(values[ends[row] : ends[row + 1]] for ends, values in lists))
        if piles:
            yield from out(piles, types, True)

    partial = df.mapInArrow(pile, T.StructType([*fields, *sums]))
    return partial.repartition(*by).sortWithinPartitions(*by).mapInArrow(merge, T.StructType([*fields, sums[0], T.StructField("consensus", T.StringType())]))


def majority(reads: DataFrame, by: list[str], query: str = "query") -> DataFrame:
    """(by, reads, consensus): the letter of most reads at each place of queries spelled along a reference; gaps that win are left out."""

    def fill(piles: list[Pile], columns: list[pa.Array]) -> None:
        for pile, text in zip(piles, columns[0].to_pylist(), strict=True):
            pile.gapped(text or "")

    return _voted(reads.select(*by, query), by, fill)


def _sent(quals: str = "quals") -> Column:
    """Qualities as they go to Python, an empty list where there are none: Arrow's writer passes over the null lists of a batch anew for each of them."""
    return F.coalesce(F.col(quals).cast("array<int>"), F.array().cast("array<int>")).alias("quals")


def _quals(column: pa.Array) -> list[np.ndarray | None]:
    ends = column.offsets.to_numpy()
    if ends[0] == ends[-1]:
        return [None] * len(column)
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] if a < b else None for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _places(starts: pa.Array, cigars: pa.Array) -> list[tuple[int, str] | None]:
    rows = zip(starts.to_pylist(), cigars.to_pylist(), strict=True)
    return [(start, cigar) if start is not None and start >= 0 and cigar and cigar != "*" else None for start, cigar in rows]


def by_alignment(reads: DataFrame, by: list[str]) -> DataFrame:
    """(by, reads, consensus) of reads (by, query_seq, quals, ref_start, cigar) by their given alignments; places without votes are left out."""

    def fill(piles: list[Pile], columns: list[pa.Array]) -> None:
        vote(piles, columns[0], _quals(columns[1]), _places(columns[2], columns[3]))

    return _voted(reads.select(*by, "query_seq", _sent(), "ref_start", "cigar"), by, fill)


def _one_gap(read: np.ndarray, draft: np.ndarray, reads: np.ndarray, drafts: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Where one gap lies in each read that begins at a place of all letters, on its draft; 0 where another path may score as much.

    With one base missing, or one or two too many, and one change at most, these are all paths that could: none or one
    gap of another size, or two gaps of one base. They are excluded by the runs without changes at both ends of their diagonals.
    """
    reach, side = int(n.max()), 4
    column = np.arange(reach)
    inside = column < n[:, None]
    a = np.where(inside, _CODE[read[np.minimum(reads[:, None] + column, len(read) - 1)]], 5)
    b = np.full((len(n), reach + 2 * side), 6, np.int8)
    there = column < m[:, None]
    b[:, side : side + reach] = np.where(there, _CODE[draft[np.minimum(drafts[:, None] + column, len(draft) - 1)]], 6)
    # A draft may be a base longer than the longest read.
    last = np.flatnonzero(m > reach)
    b[last, side + reach] = _CODE[draft[drafts[last] + reach]]
    plain = ~((a == 4).any(axis=1) | (b == 4).any(axis=1))
    off = {d: (a != b[:, side + d : side + d + reach]) & inside for d in range(-3, 4)}
    front = {d: np.where(x.any(axis=1), x.argmax(axis=1), n) for d, x in off.items()}
    back = {d: np.where(x.any(axis=1), n - reach + x[:, ::-1].argmax(axis=1), n) for d, x in off.items()}
    before = {d: np.cumsum(x, axis=1, dtype=np.int32) for d, x in off.items() if d != 2 and d != 3}
    out = np.zeros(len(n), np.int64)
    changes = np.full(len(n), 9)
    worth = SCORES.match + SCORES.mismatch
    for k in (-1, 1, 2):
        some = np.flatnonzero((n - m == k) & plain & (n > 3) & (m > 1))
        if not len(some):
            continue
        # Changes with the gap behind p bases, p from 1 on.
        ahead, behind = before[0][some], before[-k][some]
        gone = max(k, 0)
        last = np.concatenate([behind[:, gone:], np.repeat(behind[:, -1:], gone, axis=1)], axis=1)
        cost = ahead + behind[:, -1:] - last
        cost = np.where(column + 1 <= (n[some] - max(k, 1))[:, None], cost, 9)
        at, least = cost.argmin(axis=1), cost.min(axis=1)
        good = least <= 1
        f, e, size = {d: x[some] for d, x in front.items()}, {d: x[some] for d, x in back.items()}, n[some]
        clear = lambda x, y, gap: f[x] + e[y] + gap < size  # noqa: E731, B023
        one = least == 1
        if k == -1:
            for d in (0, 1):
                good &= worth * before[d][some][:, -1] > worth * least + SCORES.gap(1)
            rest = clear(0, -1, 1) & clear(1, 0, 1) & clear(2, 1, 1) & clear(0, -2, 2) & clear(1, -1, 2) & clear(2, 0, 2) & clear(3, 1, 2)
        elif k == 1:
            rest = clear(0, -2, 2) & clear(1, -1, 2)
        else:
            # Two gaps of one base: the diagonal between must hold a change, wherever they are.
            lo, hi, middle = f[0], size - e[-2] - 1, before[-1][some]
            row = np.arange(len(some))
            between = np.where(hi > lo + 1, middle[row, np.clip(hi - 1, 0, reach - 1)] - middle[row, np.clip(lo, 0, reach - 1)], 0)
            rest = clear(0, -3, 3) & clear(1, -2, 3) & (between > 0)
        good &= ~one | rest
        out[some], changes[some] = np.where(good, at + 1, 0), least
    return out


def _jobs(seqs: pa.Array, drafts: pa.Array, margin: int) -> list[tuple[int, str]]:
    """(start, cigar) of each read on its draft."""
    (read, ends), (draft, stops) = _laid(seqs.to_pylist()), _laid(drafts.to_pylist())
    begin, code, cigars = _placed(read, ends[:-1], np.diff(ends), draft, stops[:-1], np.diff(stops), margin)
    return [(b, cigars[c] if c >= 0 else "*") for b, c in zip(begin.tolist(), code.tolist(), strict=True)]


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters of texts in a row, and where each text ends and the next begins. Letters of several bytes count as one."""
    return np.frombuffer("".join(texts).encode("ascii", "replace"), np.uint8), np.cumsum([0, *map(len, texts)])


def _placed(read: np.ndarray, at: np.ndarray, n: np.ndarray, draft: np.ndarray, start: np.ndarray, m: np.ndarray, margin: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """First place and number of the alignment of each read on its draft, and the alignments; -1 where no base fits.

    Reads and drafts lie in arrays of letters. Texts of one length with so few differences that no pair of gaps can pay are placed without a table.
    """
    few = 2 * SCORES.gap(1) // (SCORES.match + SCORES.mismatch)
    apart = n - m
    close = apart == 0
    equal = np.flatnonzero(close)
    for part in _parts(n[equal]):
        mine = equal[part]
        row, place = _spans(at[mine], n[mine])
        other = _CODE[read[place]] != _CODE[draft[place + (start[mine] - at[mine])[row]]]
        close[mine] = np.bincount(row[other], minlength=len(mine)) <= few
    sizes, code = np.unique(n, return_inverse=True)
    cigars, begin = [f"{k}M" if k else "" for k in sizes.tolist()], np.zeros(len(n), np.int64)
    far = np.flatnonzero(~close)
    # Paths with one gap are known for the costs that SCORES has.
    single = far[(apart[far] >= -1) & (apart[far] <= 2) & (apart[far] != 0) & (n[far] <= TEXT)] if SCORES == Scores() and margin >= 3 else far[:0]
    single = single[np.argsort(n[single], kind="stable")]
    for part in _parts(n[single] * 64):
        mine = single[part]
        gap = _one_gap(read, draft, at[mine], start[mine], n[mine], m[mine])
        mine, gap = mine[gap > 0], gap[gap > 0]
        kinds, which = np.unique(np.stack([n[mine], gap, apart[mine]]), axis=1, return_inverse=True)
        close[mine], code[mine] = True, len(cigars) + which.ravel()
        for size, p, k in kinds.T.tolist():
            rest = size - p - max(k, 0)
            cigars.append(f"{p}M{abs(k)}{'I' if k > 0 else 'D'}" + (f"{rest}M" if rest else ""))
    where = np.flatnonzero(~close).tolist()
    jobs = []
    for k in where:
        a, b = _CODE[draft[start[k] : start[k] + m[k]]], _CODE[read[at[k] : at[k] + n[k]]]
        jobs.append((a, b, min(0, len(a) - len(b)) - margin, max(0, len(a) - len(b)) + margin))
    for k, (_, first, cigar, _) in zip(where, extend(jobs, SCORES), strict=True):
        begin[k], code[k] = first, -1 if cigar == "*" else len(cigars)
        cigars.append(cigar)
    return begin, code, cigars


def polished(reads: DataFrame, drafts: DataFrame, by: list[str], rounds: int = ROUNDS, margin: int = MARGIN) -> DataFrame:
    """(by, reads, consensus): reads (by, seq, quals) aligned to the drafts (by, consensus) of their groups, round after round.

    Groups without a draft, and reads without any base that fits, have no vote. A read is looked for along its
    whole draft: the lengths of both may differ, but the rest of the path stays within margin of its diagonals.
    """
    scratch = Scratch(reads.sparkSession, "consensus")
    slim = reads.select(*by, "seq", _sent()).filter("seq is not null")
    now = scratch.save(drafts.select(*by, "consensus"))

    def fill(piles: list[Pile], columns: list[pa.Array]) -> None:
        vote(piles, columns[0], _quals(columns[1]), [None if place[1] == "*" else place for place in _jobs(columns[0], columns[2], margin)])

    for _ in range(rounds):
        named = now.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("consensus").alias("__draft"))
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
        met = slim.join(named, same).select(*by, "seq", "quals", "__draft")
        new = scratch.save(_voted(met, by, fill))
        moved = new.join(named, [*same, F.col("consensus") != F.col("__draft")], "left_semi")
        now = new
        if moved.isEmpty():
            break
    return now


@lru_cache(1 << 16)
def _clips(cigar: str) -> tuple[int, int]:
    """Clipped bases at both ends of a query."""
    ops = [(int(n), op) for n, op in _OPS.findall(cigar) if op != "H"]
    return ops[0][0] if ops and ops[0][1] == "S" else 0, ops[-1][0] if len(ops) > 1 and ops[-1][1] == "S" else 0


def _by_group(reads: DataFrame, by: list[str], parts: int, rounds: int, margin: int) -> DataFrame:
    """As molecules, of groups that a task can hold: all rows of a group meet once, and only its consensus leaves the task."""
    n = len(by)

    def settle(rows: pa.RecordBatch, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Groups that lie end to end, from edge to edge, so many at once as have SOME letters."""
        size = pc.binary_length(rows.column(n)).to_numpy(zero_copy_only=False)
        for some in _parts(np.add.reduceat(size, edges[:-1]), SOME):
            ends = edges[some[0] : some[-1] + 2]
            part = rows.slice(int(ends[0]), int(ends[-1] - ends[0]))
            group = np.repeat(np.arange(len(some)), np.diff(ends))
            letters, stops = _laid(part.column(n).to_pylist())
            at, width, weight = stops[:-1], np.diff(stops), _weights(_quals(part.column(n + 1)), np.diff(stops))
            begin = part.column(n + 2).fill_null(-1).to_numpy().astype(np.int64)
            named = part.column(n + 3).fill_null("*").dictionary_encode()
            cigars, code = named.dictionary.to_pylist(), named.indices.to_numpy().astype(np.int64)
            given = np.where((begin >= 0) & np.array([c not in ("", "*") for c in cigars])[code], code, -1)
            drafts, said = _tallied(group, len(some), letters, weight, at, width, begin, given, cigars)
            # The aligned parts, without the clipped bases.
            head, tail = np.array([_clips(c) for c in cigars])[code].T
            made, said = _polished(letters, weight, at + np.minimum(head, width), np.maximum(width - head - tail, 0), group, drafts, said, rounds, margin)
            first = part.take(pa.array(ends[:-1] - ends[0]))
            yield pa.RecordBatch.from_arrays([*first.columns[:n], pa.array(said, pa.int64()), pa.array(made, pa.string())], [*by, "reads", "consensus"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begins, size, letters, last = [], [], 0, 0, None
        for batch in batches:
            # Tested here: a filter would have the sequences made before they are dealt out, and again behind.
            batch = batch.filter(batch.column(n).is_valid())
            if not batch.num_rows:
                continue
            keys = list(zip(*(c.to_pylist() for c in batch.columns[:n]), strict=True))
            new = [size + k for k, (key, before) in enumerate(zip(keys, [last, *keys], strict=False)) if key != before]
            last, size = keys[-1], size + len(keys)
            begins += new
            held.append(batch)
            letters += pc.sum(pc.binary_length(batch.column(n))).as_py()
            # The last group may go on in the next batch.
            if len(begins) > 1 and letters > HOLD:
                rows, cut = pa.concat_batches(held), begins[-1]
                yield from settle(rows.slice(0, cut), np.array(begins))
                held, begins, size, letters = [rows.slice(cut)], [0], size - cut, 0
        if size:
            yield from settle(pa.concat_batches(held), np.array([*begins, size]))

    schema = T.StructType([*_keys_schema(reads, by), T.StructField("reads", T.LongType()), T.StructField("consensus", T.StringType())])
    return reads.withColumn("quals", _sent()).repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(run, schema)


def molecules(reads: DataFrame, by: list[str], rounds: int = ROUNDS, margin: int = MARGIN) -> DataFrame:
    """(by, reads, consensus) of groups of aligned reads (by, query_seq, quals, ref_start, cigar).

    The reference is the first draft: given alignments vote along it. The reads' aligned parts are then
    aligned to what they said, which settles gaps that were placed differently; reads without an
    alignment join here. Clipped bases have no vote. Groups of more than TOGETHER letters are
    spread over tasks, which add their votes each round; the others are settled in one task each.
    """
    scratch, weight = Scratch(reads.sparkSession, "molecules"), Observation()
    plain = reads.select(*by, "query_seq", F.col("quals").cast("array<int>").alias("quals"), "ref_start", "cigar")
    sizes = plain.groupBy(*by).agg(F.sum(F.length("query_seq")).alias("__letters"), F.count("*").alias("__rows"))
    sizes = sizes.observe(weight, F.sum(F.col("__letters") + ROW * F.col("__rows")).alias("weight"))
    large = scratch.save(sizes.filter(F.col("__letters") > TOGETHER).select(*(F.col(c).alias(f"__{c}") for c in by)))
    parts = max(reads.sparkSession.sparkContext.defaultParallelism, -(-(weight.get["weight"] or 0) // PART))
    if large.isEmpty():
        return scratch.save(_by_group(plain, by, parts, rounds, margin))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    out = scratch.save(_by_group(plain.join(large, same, "left_anti"), by, parts, rounds, margin))
    spread = plain.filter("query_seq is not null").join(large, same, "left_semi")
    ops = S.cigar_ops(F.col("cigar"))
    mapped = F.col("cigar").isNotNull() & (F.col("cigar") != "*")
    seq = F.when(mapped, S.aligned_query(F.col("query_seq"), ops)).otherwise(F.col("query_seq"))
    quals = F.when(mapped, S.aligned_quals(F.col("quals"), ops)).otherwise(F.col("quals"))
    return out.unionByName(polished(spread.select(*by, seq.alias("seq"), quals.alias("quals")), by_alignment(spread, by), by, rounds, margin))


def periods(bases: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the units of concatemers that lie end to end (0 if none recurs), and the rows and places of words that recur one unit later, with the distance."""
    count, size = len(ends) - 1, np.diff(ends)
    value, place = words(bases, tuple(range(WORD)))
    row = np.searchsorted(ends, place, "right") - 1
    whole = place + WORD <= ends[row + 1]
    value, row, at = value[whole], row[whole], (place - ends[row])[whole]
    order = np.argsort(row * np.int64(4 ** (WORD + 1)) + value, kind="stable")
    value, row, at = value[order], row[order], at[order]
    same = np.flatnonzero((value[1:] == value[:-1]) & (row[1:] == row[:-1]))
    row, at, apart = row[same], at[same], at[same + 1] - at[same]
    row, at, apart = row[apart >= shortest], at[apart >= shortest], apart[apart >= shortest]
    # Every read has cells for the distances up to its length.
    base = np.concatenate([[0], np.cumsum(size + 1)])
    votes = np.bincount(base[row] + apart, minlength=int(base[-1]))
    sums = np.concatenate([[0], np.cumsum(votes)])
    # Copies differ in length: neighbouring distances count together. Only distances that occur can be the unit.
    seen = np.flatnonzero(votes)
    of = np.searchsorted(base, seen, "right") - 1
    wide = np.maximum(1, ((seen - base[of]) * 0.02).astype(int))
    around = sums[np.minimum(seen + wide + 1, base[of + 1])] - sums[np.maximum(seen - wide, base[of])]
    unit = np.zeros(count, np.int64)
    # The first of those with most votes around, then the first of those with most votes within its reach.
    best = np.lexsort((seen, -around, of))
    best = best[np.flatnonzero(np.diff(of[best], prepend=-1))]
    for k in best[around[best] >= np.maximum(4, 0.08 * (seen - base[of])[best])].tolist():
        r = int(of[k])
        lo = max(int(seen[k] - wide[k]), int(base[r]))
        unit[r] = lo - base[r] + int(votes[lo : min(int(seen[k] + wide[k] + 1), int(base[r + 1]))].argmax())
    near = (unit[row] > 0) & (np.abs(apart - unit[row]) <= np.maximum(2, SLACK * unit[row]))
    row, at, apart = row[near], at[near], apart[near]
    order = np.lexsort((at, row))
    return unit, row[order], at[order], apart[order]


def cuts_of(bases: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> list[list[int]]:
    """As cuts, for reads that lie end to end; all reads go from cut to cut together."""
    size = np.diff(ends)
    unit, row, at, apart = periods(bases, ends, shortest)
    out = [[0] for _ in range(len(size))]
    first = np.searchsorted(row, np.arange(len(size) + 1))
    key = ends[row] + row + at
    open_, now = np.flatnonzero((unit > 0) & (np.diff(first) > 0)), np.zeros(len(size), np.int64)
    while len(open_):
        here, u = now[open_], unit[open_]
        k = np.searchsorted(key, ends[open_] + open_ + here)
        lo, hi = first[open_], first[open_ + 1] - 1
        left, right = np.maximum(k - 1, lo), np.minimum(k, hi)
        best = np.where(np.abs(at[left] - here) <= np.abs(at[right] - here), left, right)
        # The distance where the next recurring word is; far from all of them, the usual one.
        ahead = np.where(np.abs(at[best] - here) <= u / 2, apart[best], u)
        go = (here + u <= size[open_] + SLACK * u) & (here + ahead <= size[open_])
        open_ = open_[go]
        now[open_] = (here + ahead)[go]
        for r, x in zip(open_.tolist(), now[open_].tolist(), strict=True):
            out[r].append(x)
    return out


def cuts(bases: np.ndarray, shortest: int = SHORTEST) -> list[int]:
    """Places where the units of a concatemer begin and end, from its first base on; one only if nothing recurs."""
    return cuts_of(bases, np.array([0, len(bases)]), shortest)[0]


def _units(texts: list[str], shortest: int) -> list[list[int]]:
    """Ends of the whole units of reads; reads without a repeat are one unit."""
    bases, ends = codes("".join(texts)), np.cumsum([0, *map(len, texts)])
    return [e if len(e) > 1 else [0, len(t)] for e, t in zip(cuts_of(bases, ends, shortest), texts, strict=True)]


def _weights(quals: list[np.ndarray | None], n: np.ndarray) -> np.ndarray | None:
    """Votes of every base of reads that lie end to end; None if each has one."""
    if all(q is None for q in quals):
        return None
    return np.concatenate([np.ones(k, np.int64) if q is None else np.maximum(q[:k], 1).astype(np.int64) for q, k in zip(quals, n.tolist(), strict=True)])


def _polished(letters: np.ndarray, weight: np.ndarray | None, at: np.ndarray, n: np.ndarray, group: np.ndarray, drafts: list[str], said: np.ndarray, rounds: int, margin: int) -> tuple[list[str], np.ndarray]:
    """What polished says of groups that lie in one task, and by how many reads. A draft that its reads repeat stays as it is, so only the others go on."""
    now, said, rows, left = list(drafts), said.copy(), np.arange(len(group)), np.arange(len(drafts))
    for _ in range(rounds):
        of = np.searchsorted(left, group[rows])
        draft, stops = _laid([now[g] for g in left.tolist()])
        begin, code, cigars = _placed(letters, at[rows], n[rows], draft, stops[:-1][of], np.diff(stops)[of], margin)
        new, said[left] = _tallied(of, len(left), letters, weight, at[rows], n[rows], begin, code, cigars)
        moved = np.array([text != now[g] for g, text in zip(left.tolist(), new, strict=True)], bool)
        for g, text in zip(left.tolist(), new, strict=True):
            now[g] = text
        left, rows = left[moved], rows[moved[of]]
        if not len(left):
            break
    return now, said


def _settled(texts: list[str], quals: list[np.ndarray | None], group: list[int], drafts: list[str], rounds: int, margin: int = MARGIN) -> list[str]:
    """As _polished, of texts."""
    letters, ends = _laid(texts)
    n = np.diff(ends)
    return _polished(letters, _weights(quals, n), ends[:-1], n, np.array(group, np.int64), drafts, np.zeros(len(drafts), np.int64), rounds, margin)[0]


def concatemers(reads: DataFrame, splint: str | None = None, shortest: int = SHORTEST, rounds: int = ROUNDS) -> DataFrame:
    """(read_id, read_name, repeats, consensus) of concatemer reads (read_id unique, seq, quals).

    read_name is read_id, mean quality, read length, units and consensus length, joined by ``_``. A splint is
    looked for around the circle of the consensus, on both strands, and cut out: the consensus
    then begins behind it, on the splint's strand.
    """
    names = ["read_id", "consensus", "repeats", "length", "quality"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Tested here: a filter would have the sequences made before they are dealt out, and again behind.
            batch = batch.filter(batch.column(1).is_valid())
            ids, seqs, quals = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _quals(batch.column(2))
            for some in _parts(np.array([len(s) for s in seqs])):
                lo, hi = int(some[0]), int(some[-1]) + 1
                texts, ends = seqs[lo:hi], _units(seqs[lo:hi], shortest)
                spans = [(k, a, b) for k, e in enumerate(ends) for a, b in zip(e[:-1], e[1:], strict=True)]
                # The draft is the unit of middle place: the first and the last are more often cut short.
                middle = [(len(e) - 1) // 2 for e in ends]
                drafts = [t[e[m] : e[m + 1]] for t, e, m in zip(texts, ends, middle, strict=True)]
                parts = [None if quals[lo + k] is None else quals[lo + k][a:b] for k, a, b in spans]
                made = _settled([texts[k][a:b] for k, a, b in spans], parts, [k for k, _, _ in spans], drafts, rounds)
                quality = [0.0 if q is None or not len(q) else float(q.mean()) for q in quals[lo:hi]]
                columns = (ids[lo:hi], made, [len(e) - 1 for e in ends], list(map(len, texts)), quality)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    # The units of a read never leave its task; what is said of them is written once.
    slim = reads.select(F.col("read_id").cast("string").alias("read_id"), "seq", _sent())
    out = Scratch(reads.sparkSession, "concatemers").save(slim.mapInArrow(run, "read_id string, consensus string, repeats long, length int, quality double"))
    out = out.withColumn("quality", F.round("quality", 2))
    if splint:
        out = _turned(out, splint)
    name = F.concat_ws("_", "read_id", F.col("quality").cast("string"), F.col("length").cast("string"), F.col("repeats").cast("string"), F.length("consensus").cast("string"))
    return out.select("read_id", name.alias("read_name"), "repeats", "consensus")


def _turned(df: DataFrame, splint: str) -> DataFrame:
    turn = str.maketrans(S.IUPAC, S.COMPLEMENTS)
    sides = [splint.upper(), splint.upper().translate(turn)[::-1]]
    where = df.columns.index("consensus")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            jobs = [(codes(t + t[: len(splint)]), codes(s), -len(splint), len(t) + len(splint)) for t in texts for s in sides]
            found, out = extend(jobs, SCORES), []
            for k, t in enumerate(texts):
                side = 0 if found[2 * k][0] >= found[2 * k + 1][0] else 1
                score, start, cigar, _ = found[2 * k + side]
                span = sum(int(n) for n, op in _OPS.findall(cigar) if op in "MD")
                if score > 0 and t:
                    round_ = (t + t)[start + span : start + len(t)] if start + span <= len(t) else (t + t)[start + span - len(t) : start]
                    t = round_.translate(turn)[::-1] if side else round_
                out.append(t)
            columns = list(batch.columns)
            columns[where] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(run, df.schema)
