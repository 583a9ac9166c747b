"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are compared as words (lower-cased A-Z, split at white space and ASCII
punctuation). An item of ``n`` words is found in a document when some run of
the document's words is within ``floor(rate * n)`` word edits of it.

*Windows.* An item's alignment with at most ``k`` edits leaves one of its
``k + 1`` equal segments untouched (pigeonhole), so every hit has such a segment in
it. Item-sized windows are tried on the diagonal of each segment found and up to
``SHIFTS`` words beside it; edits before the segment may move the item's start up to
``k`` words farther, which the embedding bears with and ``recall`` accounts for.

*Embedding.* A random walk (CGK) reads a window and repeats or advances at
each step as a random function of step and word says; a few word
edits cost few mismatches, so edit distance turns into Hamming distance.

*LSH.* Each repetition walks anew and samples ``SAMPLED`` coordinates of the first
``REACH`` n steps; a window and an item of its length that agree on them are a
candidate pair. What a walk shows behind the end of its text agrees with nothing,
so unrelated texts meet by chance words alone. The repetitions that an item length
needs follow from ``recall``: texts of the nearest lengths tried, with the most edits
allowed, are searched for with the keys in use, until so few are missed. Lengths
that need more than ``MOST_REPETITIONS``, or are longer than those tried
(``LONGEST_TRIED`` words), do without LSH: all of their windows are verified.

*Verification.* Candidates are aligned exactly (semi-global edit distance).

Defined cases: null or empty texts, on either side, match nothing. Items with
fewer than ``1 / rate`` words need an exact run. Repeated rows give repeated
results; null ids are carried through. Other columns are ignored, or kept as they
are by ``drop_contaminated``, which judges every row by its own text. Empty tables
on either side give no hits. Texts are searched whole, however long. Item sets of
more than ``block`` rows or ``block_bytes`` bytes are worked off in blocks, each over all
documents, so what is sent to the tasks is bounded (by the longest item, at least).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import col, filter_batches
from strandframe.llm._store import ready
from strandframe.llm._words import mix64, word_hashes, word_slices

_U = np.uint64
SAMPLED, SHIFTS, MOST_REPETITIONS = 2, 2, 96
#: Steps of a walk that are sampled, as a multiple of the words: nearly all walks end behind that.
REACH = 1.8
#: Trials of a length, within so many words altogether; the longest length that is tried.
TRIALS, TRIED_WORDS, LONGEST_TRIED = 600, 1 << 23, 256
_ITEM_PAD, _PAD = _U(0x9E6C63D0876A9A35), _U(0x5851F42D4C957F2D)
_BITS = 20


def walk(windows: np.ndarray, seed: int, steps: int, pad: np.uint64) -> np.ndarray:
    """The first steps of the CGK embedding of rows of words: (steps, rows). Behind a row's end it shows pad."""
    count, n = windows.shape
    flat = np.concatenate([windows, np.full((count, 1), pad, _U)], axis=1).ravel()
    factors = np.random.default_rng(seed).integers(1, 1 << 63, steps, dtype=np.uint64) * _U(2) + _U(1)
    out, at, rows = np.empty((steps, count), _U), np.zeros(count, np.int64), np.arange(count) * (n + 1)
    for j in range(steps):
        word = flat[rows + at]
        out[j] = word
        at += ((word * factors[j]) >> _U(63)).astype(np.int64)
        np.minimum(at, n, out=at)
    return out


def lsh_key(windows: np.ndarray, r: int, pad: np.uint64) -> np.ndarray:
    """(rows,): sampled coordinates of the walk of repetition r, as one key. Windows and items have another pad each, so an end never agrees."""
    count, n = windows.shape
    seed = 1000003 * n + r
    picks = np.sort(np.random.default_rng(seed + 1).integers(0, max(1, int(REACH * n)), SAMPLED))
    key = np.full(count, seed, _U)
    walked = walk(windows, seed, int(picks[-1]) + 1, pad)
    for p in picks:
        key = mix64(key ^ walked[p])
    return key


def lsh_keys(windows: np.ndarray, repetitions: int, pad: np.uint64) -> np.ndarray:
    """(rows, repetitions): the keys of all repetitions."""
    keys = np.empty((len(windows), repetitions), _U)
    for r in range(repetitions):
        keys[:, r] = lsh_key(windows, r, pad)
    return keys


def _trial(rnd: np.random.Generator, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """An item of n random words, and the windows that a search for it tries in a text with k edits of it."""
    item = rnd.integers(1, 1 << 62, n).astype(_U)
    words, origin = item.tolist(), list(range(n))
    for _ in range(k):
        p, kind = int(rnd.integers(len(words))), int(rnd.integers(3))
        words[p : p + (kind > 0)] = [] if kind == 1 else [int(rnd.integers(1, 1 << 62))]
        origin[p : p + (kind > 0)] = [] if kind == 1 else [-1]
    size, at = n // (k + 1), {o: p for p, o in enumerate(origin) if o >= 0}
    whole = [s for s in range(0, size * (k + 1), size) if s in at and origin[at[s] : at[s] + size] == list(range(s, s + size))]
    starts = np.array(sorted({at[s] - s + d for s in whole for d in range(-SHIFTS, SHIFTS + 1)}), np.int64)
    around = n + k + SHIFTS
    text = np.concatenate([rnd.integers(1, 1 << 62, around).astype(_U), np.array(words, _U), rnd.integers(1, 1 << 62, around).astype(_U)])
    return item, text[(around + starts)[:, None] + np.arange(n)]


@lru_cache(maxsize=None)
def enough(n: int, k: int, recall: float) -> int | None:
    """Repetitions that find items of n words with k edits, by trial; None beyond MOST_REPETITIONS.

    Half the misses that recall allows are taken, as a margin for the trials' own error.
    """
    if not k:
        return 4
    rnd = np.random.default_rng(1000003 * n + k)
    count = max(100, min(TRIALS, TRIED_WORDS // ((k + 1) * (2 * SHIFTS + 1) * n)))
    trials = [_trial(rnd, n, k) for _ in range(count)]
    for r in range(MOST_REPETITIONS):
        left, lo = [], 0
        while lo < len(trials):
            part, rows = [], 0
            while lo < len(trials) and (not part or rows < 4096):
                part.append(trials[lo])
                rows, lo = rows + len(trials[lo][1]), lo + 1
            items, windows = lsh_key(np.stack([i for i, _ in part]), r, _ITEM_PAD), lsh_key(np.concatenate([w for _, w in part]), r, _PAD)
            owner = np.repeat(np.arange(len(part)), [len(w) for _, w in part])
            met = np.zeros(len(part), bool)
            met[owner[windows == items[owner]]] = True
            left += [t for t, m in zip(part, met, strict=True) if not m]
        trials = left
        if len(trials) <= count * (1 - recall) / 2:
            return max(4, r + 1)
    return None


def repetitions(n: int, rate: float, recall: float) -> int | None:
    """Repetitions for items of n words: what the lengths tried on both sides of n need, so that no item sets those of another.

    None, for verification of all windows, beyond the lengths tried or MOST_REPETITIONS.
    """
    if not math.floor(rate * n + 1e-9):
        return 4
    tried = sorted({round(2 ** (e / 2)) for e in range(2, 2 * LONGEST_TRIED.bit_length() - 1)})
    if n > tried[-1]:
        return None
    around = {max(t for t in tried if t <= n), min(t for t in tried if t >= n)} if n >= tried[0] else {tried[0]}
    found = [enough(t, max(1, math.floor(rate * t + 1e-9)), recall) for t in around]
    return None if None in found else max(found)


def closest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the run of text nearest to item; ties: shortest, then first."""
    width = len(text) + 1
    cost, start, ramp = np.zeros(width, np.int64), np.arange(width), np.arange(width)
    for i, word in enumerate(item):
        # One number holds cost and start, so that minima carry the later start along.
        diagonal = (cost[:-1] + (text != word)) * width + (width - 1 - start[:-1])
        above = (cost + 1) * width + (width - 1 - start)
        best = above.copy()
        best[1:] = np.minimum(best[1:], diagonal)
        best = np.minimum.accumulate(best - ramp * width) + ramp * width
        cost, start = best // width, width - 1 - best % width
    d = int(cost.min())
    ends = np.flatnonzero(cost == d)
    e = int(ends[np.argmin(ends - start[ends])])
    return d, int(start[e]), e


class ItemIndex:
    """Segments and LSH keys of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple[int, np.ndarray]], rate: float, recall: float):
        self.items = [(i, w) for i, w in items if len(w)]
        self.edits = [math.floor(rate * len(w) + 1e-9) for _, w in self.items]
        self.repetitions = {n: repetitions(n, rate, recall) for n in sorted({len(w) for _, w in self.items})}
        seeds: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        by_length: dict[int, list[int]] = defaultdict(list)
        for x, ((_, words), k) in enumerate(zip(self.items, self.edits, strict=True)):
            size = len(words) // (k + 1)
            for s in range(0, size * (k + 1), size):
                seeds[size][int(gram(words[s : s + size], size)[0])].append((x, s))
            by_length[len(words)].append(x)
        self.seeds = {}
        for size, table in seeds.items():
            keys = np.array(sorted(table), _U)
            maybe = np.zeros(1 << _BITS, bool)
            maybe[(keys >> _U(64 - _BITS)).astype(np.int64)] = True
            self.seeds[size] = (maybe, keys, [table[int(k)] for k in keys])
        self.keys = {}
        for n, members in by_length.items():
            if self.repetitions[n] is None:
                continue
            keys = lsh_keys(np.stack([self.items[x][1] for x in members]), self.repetitions[n], _ITEM_PAD)
            self.keys[n] = [defaultdict(list) for _ in range(self.repetitions[n])]
            for row, x in zip(keys, members, strict=True):
                for r, key in enumerate(row.tolist()):
                    self.keys[n][r][key].append(x)

    def windows(self, words: np.ndarray, bounds: np.ndarray) -> tuple[dict[int, set[tuple[int, int]]], set[tuple[int, int, int]]]:
        """By item length: (row, start in words) of windows on the diagonal of an untouched segment.

        For lengths without LSH: (row, item, start).
        """
        found: dict[int, set[tuple[int, int]]] = defaultdict(set)
        direct: set[tuple[int, int, int]] = set()
        for size, (maybe, keys, places) in self.seeds.items():
            if len(words) < size:
                continue
            grams = gram(words, size)
            at = np.flatnonzero(maybe[(grams >> _U(64 - _BITS)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(keys, grams[at]), len(keys) - 1)
            hit = keys[slot] == grams[at]
            at, slot = at[hit], slot[hit]
            rows = np.searchsorted(bounds, at, "right") - 1
            whole = at + size <= bounds[rows + 1]
            for p, s, row in zip(at[whole].tolist(), slot[whole].tolist(), rows[whole].tolist(), strict=True):
                for x, offset in places[s]:
                    n = len(self.items[x][1])
                    if self.repetitions[n] is None:
                        direct.add((row, x, p - offset))
                    else:
                        found[n].add((row, p - offset))
        return found, direct

    def search(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end) of the best run for each row and item within reach."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        checked = set()
        found, direct = self.windows(words, bounds)
        for row, x, s in sorted(direct):
            self._verify(words, bounds, row, x, s, best)
        for n, diagonals in found.items():
            spots = sorted({(row, s + shift) for row, s in diagonals for shift in range(-SHIFTS, SHIFTS + 1)})
            for lo in range(0, len(spots), 2048):
                part = np.array(spots[lo : lo + 2048])
                low, high = bounds[part[:, 0]], bounds[part[:, 0] + 1]
                index = part[:, 1][:, None] + np.arange(n)
                inside = (index >= low[:, None]) & (index < high[:, None])
                windows = np.where(inside, words[np.clip(index, 0, len(words) - 1)], _PAD)
                keys = lsh_keys(windows, self.repetitions[n], _PAD)
                for r, table in enumerate(self.keys[n]):
                    for w, key in enumerate(keys[:, r].tolist()):
                        for x in table.get(key, ()):
                            row, s = int(part[w, 0]), int(part[w, 1])
                            if (row, x, s) not in checked:
                                checked.add((row, x, s))
                                self._verify(words, bounds, row, x, s, best)
        for (row, x), (d, s, e) in sorted(best.items()):
            yield row, x, d, s, e

    def _verify(self, words, bounds, row: int, x: int, s: int, best: dict) -> None:
        item, k = self.items[x][1], self.edits[x]
        if best.get((row, x), (k + 1,))[0] == 0:
            return
        lo = max(int(bounds[row]), s - 2 * k - SHIFTS)
        hi = min(int(bounds[row + 1]), s + len(item) + 2 * k + SHIFTS)
        d, start, end = closest(item, words[lo:hi])
        got = (d, lo + start - int(bounds[row]), lo + end - int(bounds[row]))
        if d <= k and ((row, x) not in best or got < best[row, x]):
            best[row, x] = got


def gram(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of size words."""
    value = np.full(len(words) - size + 1, size, _U)
    for k in range(size):
        value = mix64(value * _U(0x9E3779B97F4A7C15) + words[k : k + len(value)])
    return value


def _find(index) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            for w in word_slices(batch.column(1), punctuation=True):
                for row, x, d, s, e in index.value.search(w.hashes, w.bounds):
                    item, words = index.value.items[x]
                    for column, v in zip(out, (w.first + row, item, d, len(words), s, e), strict=True):
                        column.append(v)
            ids = batch.column(0).take(pa.array(out[0], pa.int64()))
            rest = [pa.array(v, t) for v, t in zip(out[1:], (pa.int64(), *[pa.int32()] * 4), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *rest], ["id", "item_id", "distance", "item_words", "start_word", "end_word"])

    return run


def _spare(index, where: int) -> object:
    """The rows in whose text, column where, no item is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for w in word_slices(batch.column(where), punctuation=True):
                keep[[w.first + row for row, *_ in index.value.search(w.hashes, w.bounds)]] = False
            yield batch.filter(pa.array(keep))

    return run


def _indexes(items: DataFrame, item_col: str, item_text: str, rate: float, recall: float, block: int, block_bytes: int) -> Iterator:
    """Broadcast indexes of the blocks of items."""
    spark = items.sparkSession
    ready(spark)
    texts = items.select(col(item_col).cast("long").alias("i"), col(item_text).cast("string").alias("t")).filter("t is not null")
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, math.ceil(size.n / block), math.ceil(size.bytes / block_bytes))
    for b in range(blocks):
        part = texts.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).distinct().collect()
        rows = sorted(((r.i, r.t) for r in part), key=lambda r: (r[0] is None, r))
        yield spark.sparkContext.broadcast(ItemIndex([(i, word_hashes(t, True)) for i, t in rows], rate, recall))


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", rate: float = 0.2, recall: float = 0.99, block: int = 20_000, block_bytes: int = 1 << 25,
) -> DataFrame:
    """One row per document and benchmark item found in it.

    (id, item_id, distance, item_words, start_word, end_word); the run of words
    is half open and counted from 0.
    """
    slim = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    schema = "id long, item_id long, distance int, item_words int, start_word int, end_word int"
    found = [slim.mapInArrow(_find(index), schema) for index in _indexes(items, item_col, item_text, rate, recall, block, block_bytes)]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("id", id_col)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    rate: float = 0.2, recall: float = 0.99, block: int = 20_000, block_bytes: int = 1 << 25,
) -> DataFrame:
    """The rows of docs in whose text no item is found, with all their columns; no shuffle."""
    where = docs.columns.index(text_col)
    for index in _indexes(items, item_col, item_text, rate, recall, block, block_bytes):
        docs = filter_batches(docs, _spare(index, where))
    return docs
