"""Hidden Markov language model over words, with an additive unigram baseline.

*Tokens.* Words (A-Z lower-cased) and one end per text.

*Counts.* Every word of every training text is counted in a distributed
aggregation. The most frequent words, ``lookup`` at most, are sent to the tasks;
all rarer ones are joined by key when texts are scored.

*Classes.* The ``symbols`` most frequent words are symbols of their own; every
other word belongs to the class of its last letter's byte. A state emits a
symbol or a class, a class emits its words by their smoothed counts, so the
model is a proper distribution over words, with one unknown word per class.

*Training.* Baum-Welch from emissions disturbed by a seeded noise, which breaks
the symmetry between states without looking at a text. Forward and backward
passes give expected transition, start and emission counts, which are summed
over partitions; every one of the ``START_ROUNDS + passes`` rounds goes over all
training texts. The texts' symbols and classes are written once and read by
every round.

*Scoring.* The scaled forward recursion gives the exact likelihood. Texts are
cut into pieces of ``PIECE`` tokens whose transfer matrices are multiplied for
all pieces at once and then chained, which is the same product regrouped. A text of
more than ``TOKENS`` tokens is worked off in runs of so many: the state is carried
from run to run, in training also back, so that the tables of one run are held.

Defined cases: null and empty texts are one end token. Without training texts
every count is 0 and all words are equally likely in every state. Repeated
rows are scored (and, in training, counted) each. Null ids are not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import col
from strandframe.llm._store import Scratch
from strandframe.llm._words import text_buffers, word_slices

_U = np.uint64
END = _U(0x2545F4914F6CDD1D)
PIECE, RESCALE = 64, 8
TOKENS = 1 << 17
TAILS = 256
START_ROUNDS = 12
MOST_TASKS = 4096


def held_out(id_col: str, parts: int = 7, part: int = 2):
    """Whether a row is kept from learning: crc32 of the id as text. Null ids are not."""
    return F.coalesce(F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def token_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, hashes, tails, bounds) with an end after each row's words; tails: last bytes."""
    for w in word_slices(column):
        rows = w.last - w.first
        at = w.bounds[1:] + np.arange(rows)
        total = len(w.hashes) + rows
        words = np.ones(total, bool)
        words[at] = False
        hashes, tails = np.full(total, END, _U), np.zeros(total, np.uint8)
        hashes[words], tails[words] = w.hashes, w.tails
        yield w.first, w.last, hashes, tails, np.concatenate([[0], at + 1])


class Table:
    """An open-addressing table from word hash to rank, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, math.ceil(math.log2(max(1, len(keys)) * 4)))
        size = 1 << self.bits
        self.keys, self.ranks = np.zeros(size, _U), np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        slot = (keys >> _U(64 - self.bits)).astype(np.int64)
        while len(left):
            free = self.ranks[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            win = np.flatnonzero(free)[first]
            self.keys[slot[win]], self.ranks[slot[win]] = keys[left[win]], left[win]
            stay = np.ones(len(left), bool)
            stay[win] = False
            left, slot = left[stay], (slot[stay] + 1) & (size - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        mask = (1 << self.bits) - 1
        slot = (hashes >> _U(64 - self.bits)).astype(np.int64)
        out = self.ranks[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != hashes))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & mask
            rank = self.ranks[slot]
            out[open_] = rank
            go = (rank >= 0) & (self.keys[slot] != hashes[open_])
            open_, slot = open_[go], slot[go]
        return out


@dataclass
class Vocabulary:
    """The bounded part of the counts: most frequent words, and sums over all words."""

    keys: np.ndarray
    counts: np.ndarray
    symbols: int
    tokens: int  # N
    distinct: int  # V
    class_tokens: np.ndarray  # by tail, without symbols
    class_distinct: np.ndarray
    least: int | None = None  # the lowest count bin that keys holds

    def __post_init__(self):
        self.table = Table(self.keys)

    @property
    def size(self) -> int:
        return self.symbols + TAILS

    def classes(self, ranks: np.ndarray, tails: np.ndarray) -> np.ndarray:
        return np.where((ranks >= 0) & (ranks < self.symbols), ranks, self.symbols + tails.astype(np.int64))

    def prior(self) -> np.ndarray:
        """Smoothed shares of the symbols and classes."""
        own = np.concatenate([self.counts[: self.symbols] + 1.0, self.class_tokens + self.class_distinct + 1.0])
        return own / own.sum()


def count_words(train: DataFrame, text_col: str) -> DataFrame:
    """(h, tail, c): hash, last byte and count of every token of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(h, t) for _, _, h, t, _ in token_slices(batch.column(0))]
            if parts:
                keys, first, c = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_counts=True)
                tails = np.concatenate([p[1] for p in parts])[first]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tails, pa.int16()), pa.array(c, pa.int64())], ["h", "tail", "c"])

    rows = train.select(col(text_col).cast("string").alias("text")).mapInArrow(run, "h long, tail short, c long")
    return rows.groupBy("h").agg(F.min("tail").alias("tail"), F.sum("c").alias("c"))


def _bin(c):
    """Counts by 64ths of a doubling: some 3000 bins whatever the corpus."""
    return F.floor(F.log2(c) * 64)


def vocabulary(counts: DataFrame, lookup: int, symbols: int) -> Vocabulary:
    """The words of the highest count bins that hold lookup words together at most, and sums over all."""
    end = F.col("h") == F.lit(int(END.astype(np.int64)))
    least, held = None, 0
    for b, n in sorted(((r.b, r.n) for r in counts.groupBy(_bin(F.col("c")).alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if held + n > lookup:
            break
        least, held = b, held + n
    often = end if least is None else end | (_bin(F.col("c")) >= least)
    table = counts.filter(often).toArrow()
    keys, own, tails = (table.column(k).to_numpy() for k in ("h", "c", "tail"))
    order = np.lexsort((keys, -own, keys != END.astype(np.int64)))
    keys, own, tails = keys[order].view(_U), own[order], tails[order].astype(np.int64)
    if not len(keys):
        keys, own, tails = np.array([END]), np.zeros(1, np.int64), np.zeros(1, np.int64)
    by_tail = counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    symbols = min(symbols, len(keys))
    tokens, distinct = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for r in by_tail:
        tokens[r.tail], distinct[r.tail] = r.c, r.v
    total, kinds = int(tokens.sum()), int(distinct.sum())
    if total:
        np.subtract.at(tokens, tails[:symbols], own[:symbols])
        np.subtract.at(distinct, tails[:symbols], 1)
    return Vocabulary(keys, own, symbols, total, kinds, tokens, distinct, least)


@dataclass
class Model:
    start: np.ndarray  # (S,) of the state before the first token
    move: np.ndarray  # (S, S)
    emit: np.ndarray  # (classes, S)

    def scaled(self) -> tuple[np.ndarray, np.ndarray]:
        top = self.emit.max(axis=1)
        return self.emit / top[:, None], np.log(top)


class Lattice:
    """The pieces of a slice's token classes, and the passes over them.

    Arrays hold a row per state and a column per piece; tokens are ordered by
    their place in the piece, pieces by falling length, so a step of all pieces
    works on one contiguous run of columns.
    """

    def __init__(self, model: Model, classes: np.ndarray, bounds: np.ndarray):
        self.model = model
        scaled, logs = model.scaled()
        self.log_top = np.add.reduceat(logs[classes], bounds[:-1])
        lengths = np.diff(bounds)
        per_doc = -(-lengths // PIECE)
        first = np.concatenate([[0], np.cumsum(per_doc)])
        within = np.arange(first[-1]) - np.repeat(first[:-1], per_doc)
        begin = np.repeat(bounds[:-1], per_doc) + within * PIECE
        size = np.minimum(PIECE, np.repeat(bounds[1:], per_doc) - begin)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        self.pieces = len(order)
        self.active = [a for t in range(PIECE) if (a := int(np.searchsorted(-size, -t, "left")))]  # pieces longer than t
        self.classes = classes[np.concatenate([begin[:a] + t for t, a in enumerate(self.active)])]
        self.emitted = np.take(np.ascontiguousarray(scaled.T), self.classes, axis=1)
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.docs = np.argsort(-per_doc, kind="stable")
        many = per_doc[self.docs]
        self.chain = []  # by position in the document: pieces of the documents that have one there
        for j in range(int(many[0])):
            some = self.docs[: int(np.searchsorted(-many, -j, "left"))]
            self.chain.append(place[first[some] + j])

    def step(self, t: int) -> np.ndarray:
        """Scaled emissions of the t-th tokens of all pieces."""
        return self.emitted[:, self.at[t] : self.at[t + 1]]

    def forward(self, enter: np.ndarray | None = None) -> np.ndarray:
        """Natural log-likelihood of every document; enter: (S, 1) shares of the states before a lone document's tokens.

        ``left`` are those behind them.
        """
        s, move = len(self.model.start), self.model.move.T
        self.transfer, logs = np.empty((s, s, self.pieces)), np.zeros(self.pieces)  # (to, from, piece)
        now = move[:, :, None] * self.step(0)[:, None, :]
        for t, a in enumerate(self.active[1:], 1):
            if a < now.shape[2]:
                self.transfer[:, :, a : now.shape[2]] = now[:, :, a:]
            now = (move @ now[:, :, :a].reshape(s, s * a)).reshape(s, s, a)
            now *= self.step(t)[:, None, :]
            if t % RESCALE == RESCALE - 1:
                top = now.max(axis=(0, 1))
                now /= top
                logs[:a] += np.log(top)
        self.transfer[:, :, : now.shape[2]] = now
        self.entering = np.empty((s, self.pieces))
        v = np.repeat(self.model.start[:, None], len(self.docs), axis=1) if enter is None else enter.copy()
        out = np.zeros(len(self.docs))
        for at in self.chain:
            n = len(at)
            self.entering[:, at] = v[:, :n]
            w = (self.transfer[:, :, at] * v[:, :n]).sum(axis=1)
            total = w.sum(axis=0)
            v[:, :n] = w / total
            out[:n] += np.log(total) + logs[at]
        self.left, result = v, np.empty(len(self.docs))
        result[self.docs] = out
        return result + self.log_top

    def expected(self, enter: np.ndarray | None = None, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts (S,), moves (S, S) and emissions (classes, S).

        after: (S, 1) what follows a lone document's tokens says of the state behind them; ``before`` is the same of the state before them.
        """
        self.forward(enter)
        move, s = self.model.move, len(self.model.start)
        leaving, beta = np.ones((s, self.pieces)), np.ones((s, len(self.docs))) if after is None else after.copy()
        for at in reversed(self.chain):
            n = len(at)
            leaving[:, at] = beta[:, :n]
            b = (self.transfer[:, :, at] * beta[:, None, :n]).sum(axis=0)
            beta[:, :n] = b / b.sum(axis=0)
        alphas, norms, alpha = [], [], self.entering
        for t, a in enumerate(self.active):
            alpha = move.T @ alpha[:, :a]
            alpha *= self.step(t)
            norm = alpha.sum(axis=0)
            alpha /= norm
            alphas.append(alpha)
            norms.append(norm)
        seen, moves = np.empty_like(self.emitted), np.zeros((s, s))
        beta = leaving
        for t in range(len(alphas) - 1, -1, -1):
            a = self.active[t]
            post = alphas[t] * beta[:, :a]
            total = post.sum(axis=0)
            np.divide(post, total, out=seen[:, self.at[t] : self.at[t + 1]])
            w = self.step(t) * beta[:, :a]
            before = (alphas[t - 1] if t else self.entering)[:, :a]
            moves += (before / (norms[t] * total)) @ w.T
            b = move @ w
            b /= b.sum(axis=0)
            beta[:, :a] = b
        at = self.chain[0]
        self.before = beta[:, at]
        post = self.entering[:, at] * self.before
        starts = (post / post.sum(axis=0)).sum(axis=1)
        n = len(self.model.emit)
        emits = np.stack([np.bincount(self.classes, weights=seen[k], minlength=n) for k in range(s)], axis=1)
        return starts, moves * move, emits


def runs(tokens: int, bounds: np.ndarray) -> list[slice]:
    """Of a slice's tokens: all at once, or, of a lone long document, TOKENS at a time."""
    step = TOKENS if len(bounds) == 2 else max(1, tokens)
    return [slice(at, min(at + step, tokens)) for at in range(0, tokens, step)]


def expected_counts(model: Model, classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lattice.expected, of a lone long document run by run: the states forward, then the counts backward."""
    parts = runs(len(classes), bounds)
    if len(parts) == 1:
        return Lattice(model, classes.astype(np.int64), bounds).expected()
    enters, after = [model.start[:, None]], None
    lattice_of = lambda part: Lattice(model, classes[part].astype(np.int64), np.array([0, part.stop - part.start]))
    for part in parts[:-1]:
        lattice = lattice_of(part)
        lattice.forward(enters[-1])
        enters.append(lattice.left)
    moves, emits = 0.0, 0.0
    for part, enter in zip(reversed(parts), reversed(enters), strict=True):
        lattice = lattice_of(part)
        starts, m, e = lattice.expected(enter, after)
        moves, emits, after = moves + m, emits + e, lattice.before
    return starts, moves, emits


def reestimate(starts, moves, emits, prior: np.ndarray, strength: float = 200.0) -> Model:
    emits = emits + strength * prior[:, None]
    moves, starts = moves + 0.1, starts + 0.1
    return Model(starts / starts.sum(), moves / moves.sum(axis=1)[:, None], emits / emits.sum(axis=0))


def first_model(words: Vocabulary, states: int) -> Model:
    """Broken symmetry: emissions of every state off the prior by a seeded noise."""
    rnd, prior = np.random.default_rng(7), words.prior()
    emit = prior[:, None] * np.exp(0.5 * rnd.standard_normal((len(prior), states)))
    move = np.full((states, states), 0.2 / states) + np.eye(states) * 0.8
    return Model(np.full(states, 1 / states), move / move.sum(axis=1)[:, None], emit / emit.sum(axis=0))


def _code_type(words: Vocabulary) -> np.dtype:
    return np.dtype("<u2" if words.size <= 1 << 16 else "<u4")


def encode(train: DataFrame, text_col: str, words: Vocabulary) -> DataFrame:
    """(codes): the symbols and classes of every row's tokens, as fixed-width numbers."""
    shared, kind = train.sparkSession.sparkContext.broadcast(words), _code_type(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for _, _, h, t, b in token_slices(batch.column(0)):
                codes = np.empty(len(h), kind)
                for part in runs(len(h), b):
                    codes[part] = words.classes(words.table.find(h[part]), t[part])
                offsets = pa.py_buffer((b * kind.itemsize).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(b) - 1, [None, offsets, pa.py_buffer(codes)])], ["codes"])

    return train.select(col(text_col).cast("string").alias("text")).mapInArrow(run, "codes binary")


def code_slices(column: pa.Array, kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(classes, bounds) of encoded rows, in slices of whole rows."""
    data, offsets = text_buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + TOKENS * kind.itemsize, "right")) - 1)
        part = np.frombuffer(data[offsets[first] : offsets[last]].tobytes(), kind)
        yield part, (offsets[first : last + 1] - offsets[first]) // kind.itemsize
        first = last


def baum_welch(coded: DataFrame, words: Vocabulary, model: Model) -> Model:
    """One pass over all encoded rows; the counts are summed by class over partitions."""
    context, states, size, kind = coded.sparkSession.sparkContext, len(model.start), words.size, _code_type(words)
    shared = context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros((size + 1 + states, states))
        for batch in batches:
            for classes, b in code_slices(batch.column(0), kind):
                starts, moves, emits = expected_counts(model, classes, b)
                total[:size] += emits
                total[size] += starts
                total[size + 1 :] += moves
        some = np.flatnonzero(total.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(total[some, k]) for k in range(states))], names)

    names = ["row", *(f"s{k}" for k in range(states))]
    # A task sends up to a row per class: fewer, longer tasks where there are far more partitions than cores.
    coded = coded.coalesce(max(MOST_TASKS, 4 * context.defaultParallelism))
    rows = coded.mapInArrow(run, "row int, " + ", ".join(f"{n} double" for n in names[1:]))
    got = rows.groupBy("row").agg(*(F.sum(n).alias(n) for n in names[1:])).collect()
    shared.unpersist()
    total = np.zeros((size + 1 + states, states))
    for r in got:
        total[r.row] = r[1:]
    return reestimate(total[size], total[size + 1 :], total[:size], words.prior())


def fit(train: DataFrame, text_col: str, words: Vocabulary, states: int, rounds: int, scratch: Scratch) -> Model:
    """The model after so many rounds over all rows of train."""
    model = first_model(words, states)
    coded = scratch.save(encode(train, text_col, words), "codes")
    for _ in range(rounds if words.tokens else 1):
        model = baum_welch(coded, words, model)
    scratch.drop(coded)
    return model


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train=None,
    states: int = 4, symbols: int = 16_384, lookup: int = 262_144, passes: int = 2,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; logs base 10.

    train: a condition on docs for the rows to learn from; not held_out(id_col) by default.
    """
    scratch = Scratch(docs.sparkSession, "hmm")
    out_of = held_out(id_col) if train is None else ~train
    learned = docs.filter(~out_of)
    counts = scratch.save(count_words(learned, text_col), "counts")
    words = vocabulary(counts, lookup, symbols)
    model = fit(learned, text_col, words, states, START_ROUNDS + passes, scratch)
    shared = docs.sparkSession.sparkContext.broadcast((words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        known = np.log10(words.counts + 1.0)
        with np.errstate(divide="ignore"):
            inside = np.log10(words.class_tokens + words.class_distinct + 1.0)
        per_token = math.log10(words.tokens + words.distinct + 1)
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last, h, t, b in token_slices(batch.column(2)):
                n, per_run, enter = np.diff(b), [], None
                for part in runs(len(h), b):
                    ranks = words.table.find(h[part])
                    classes = words.classes(ranks, t[part])
                    own = np.where(ranks >= 0, known[np.maximum(ranks, 0)], 0.0)
                    begins = b[:-1] - part.start if part.stop - part.start == len(h) else np.zeros(1, np.int64)
                    lattice = Lattice(model, classes, np.append(begins, len(classes)))
                    hmm = lattice.forward(enter) / math.log(10)
                    hmm += np.add.reduceat(np.where(classes >= words.symbols, own - inside[t[part]], 0.0), begins)
                    per_run.append((hmm, np.add.reduceat(own, begins), np.add.reduceat((ranks >= 0).astype(np.int64), begins), ranks < 0))
                    enter = lattice.left
                hmm, base, found = (sum(r[k] for r in per_run) for k in range(3))
                base, found = base - n * per_token, found if words.tokens else np.zeros(last - first, np.int64)
                rest = np.concatenate([r[3] for r in per_run])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(serial + np.arange(last - first)), batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                        pa.array(n, pa.int64()), pa.array(found), pa.array(base), pa.array(hmm),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rest)])[b].astype(np.int32)), pa.array(h[rest].view(np.int64))),
                    ],
                    ["row", "id", "out", "n", "found", "base", "hmm", "rare"],
                )
                serial += last - first

    slim = docs.select(col(id_col).cast("long").alias("id"), out_of.alias("out"), col(text_col).cast("string").alias("text"))
    local = scratch.save(
        slim.mapInArrow(run, "row long, id long, out boolean, n long, found long, base double, hmm double, rare array<long>"), "local"
    )
    rare = local.select("row", F.explode("rare").alias("h"))
    seldom = (counts if words.least is None else counts.filter(_bin(F.col("c")) < words.least)).select("h", "c")
    more = rare.join(seldom, "h").groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("gain"), F.count("*").alias("more"))
    joined = local.drop("rare").join(more, "row", "left").fillna({"gain": 0.0, "more": 0})
    return joined.select(
        F.col("id").alias(id_col), F.col("out").alias("held_out"), F.col("n").alias("n_tokens"), (F.col("found") + F.col("more")).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.col("gain")).alias("base_score"), (F.col("hmm") + F.col("gain")).alias("score"),
    )
