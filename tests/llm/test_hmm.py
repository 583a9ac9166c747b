import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from strandframe.llm import hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["\0end"]


def tiny_model(states=3, size=40):
    rnd = np.random.default_rng(1)
    emit, move = rnd.random((size, states)), rnd.random((states, states)) + np.eye(states)
    return hmm.Model(np.full(states, 1 / states), move / move.sum(1)[:, None], emit / emit.sum(0))


def plain_forward(model, classes):
    """(log-likelihood, starts, moves, emits) of one sequence by the textbook recursions."""
    a, e, s = model.move, model.emit[classes], len(model.start)
    alpha, scale = [model.start], []
    for t in range(len(classes)):
        v = (alpha[-1] @ a) * e[t]
        scale.append(v.sum())
        alpha.append(v / v.sum())
    beta, starts, moves, emits = np.ones(s), None, np.zeros((s, s)), np.zeros_like(model.emit)
    for t in range(len(classes) - 1, -1, -1):
        post = alpha[t + 1] * beta
        emits[classes[t]] += post / post.sum()
        w = e[t] * beta
        x = alpha[t][:, None] * a * w
        moves += x / x.sum()
        beta = a @ w / w.sum()
    starts = model.start * beta / (model.start * beta).sum()
    return np.log(scale).sum(), starts, moves, emits


def test_pieces_give_the_textbook_recursions():
    model, rnd = tiny_model(), np.random.default_rng(2)
    seqs = [rnd.integers(0, 40, n) for n in (1, 5, 32, 33, 64, 200, 2, 7)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    lattice = hmm.Lattice(model, np.concatenate(seqs), bounds)
    want = [plain_forward(model, s) for s in seqs]
    assert np.allclose(lattice.forward(), [w[0] for w in want])
    for got, i in zip(lattice.expected(), (1, 2, 3), strict=True):
        assert np.allclose(got, sum(w[i] for w in want))


def test_baum_welch_never_lowers_the_likelihood():
    model, rnd = tiny_model(), np.random.default_rng(4)
    bounds = np.arange(0, 401, 40)
    classes = np.concatenate([rnd.integers(0, 20, 200), rnd.integers(20, 40, 200)])
    last = -np.inf
    for _ in range(6):
        lattice = hmm.Lattice(model, classes, bounds)
        now = lattice.forward().sum()
        assert now >= last - 1e-9
        last, (starts, moves, emits) = now, lattice.expected()
        model = hmm.Model(starts / starts.sum(), moves / moves.sum(1)[:, None], emits / emits.sum(0))


def test_lookup_table():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)) * np.uint64(3)
    table = hmm.Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == -1).all()


def check_scores(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in hmm.score(docs, **options).collect()}
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not out[i] for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        r, tokens = got[i], words_of(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
    return got


def test_counts_and_base_on_the_small_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    full = check_scores(spark, rows, passes=1)
    few = check_scores(spark, rows, passes=1, lookup=300, symbols=100)
    held = [r for r in full.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in few.values())


def test_word_probabilities_sum_to_one(spark):
    rows = [(i, "aa bb cc aa dd") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = hmm.count_words(docs, "text")
    words = hmm.vocabulary(counts, 3, 2)
    mass = words.class_tokens + words.class_distinct
    assert words.tokens == 120 and words.distinct == 5
    for tail in range(256):
        inside = mass[tail] + 1
        assert (mass[tail] + 1) / inside == 1
    assert math.isclose(words.prior().sum(), 1)


def test_nulls_empty_texts_and_tables(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (None, "a b"), (9, " ")]
    got = check_scores(spark, rows)
    assert got[1].n_tokens == 1 and got[2].score == got[1].score
    assert hmm.score(spark.createDataFrame([], "doc_id long, text string, id string")).count() == 0
    only = spark.createDataFrame([(5, "a b", "x", "y")], "doc_id long, text string, row string, id string")
    from pyspark.sql import functions as F

    r = hmm.score(only, train=F.lit(False)).first()
    assert (r.n_known, r.train_tokens) == (0, 0) and math.isfinite(r.score)
    assert token_rows(["a B", None]) == [3, 1]


def token_rows(texts):
    return [n for _, _, _, _, b in hmm.token_slices(pa.array(texts, pa.string())) for n in np.diff(b).tolist()]


def test_every_round_covers_all_training_texts(spark):
    rnd = np.random.default_rng(3)
    texts = [" ".join(f"{'ab'[i % 2]}{rnd.integers(0, 30)}" for _ in range(int(rnd.integers(0, 50)))) for i in range(1200)]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words = hmm.vocabulary(hmm.count_words(train, "text"), 1000, 40)
    want = hmm.first_model(words, 3)
    parts = [(words.classes(words.table.find(h), t), b) for _, _, h, t, b in hmm.token_slices(pa.array(texts, pa.string()))]
    for _ in range(4):
        sums = [hmm.Lattice(want, c, b).expected() for c, b in parts]
        want = hmm.reestimate(*(sum(x) for x in zip(*sums, strict=True)), words.prior())
    got = hmm.fit(train, "text", words, 3, 4, hmm.Scratch(spark, "hmm"))
    assert np.allclose(got.start, want.start) and np.allclose(got.move, want.move) and np.allclose(got.emit, want.emit)


def test_long_texts_are_worked_off_in_runs(spark, monkeypatch):
    model, rnd = tiny_model(), np.random.default_rng(6)
    classes = rnd.integers(0, 40, 1000)
    bounds = np.array([0, 1000])
    want = plain_forward(model, classes)
    monkeypatch.setattr(hmm, "TOKENS", 96)
    assert len(hmm.runs(1000, bounds)) == 11 and len(hmm.runs(1000, np.array([0, 400, 1000]))) == 1
    for got, right in zip(hmm.expected_counts(model, classes.astype(np.uint16), bounds), want[1:], strict=True):
        assert np.allclose(got, right, rtol=1e-9)


def test_long_texts_score_as_short_runs_do(spark):
    rnd = np.random.default_rng(8)
    long = " ".join(f"w{x}" for x in rnd.integers(0, 3000, 400_000))
    rows = [(1, long), (2, "w1 w2"), (3, None), (4, "x" * 3_000_000 + " w1"), (9, long[:5000])]
    got = check_scores(spark, rows, passes=-10, lookup=1000, symbols=500)
    assert got[1].n_tokens == 400_001 and all(math.isfinite(r.score) for r in got.values())
    model, classes = tiny_model(), rnd.integers(0, 40, 300_000)
    enter, total = None, 0.0
    for part in hmm.runs(len(classes), np.array([0, len(classes)])):
        lattice = hmm.Lattice(model, classes[part], np.array([0, part.stop - part.start]))
        total, enter = total + lattice.forward(enter)[0], lattice.left
    assert math.isclose(total, hmm.Lattice(model, classes, np.array([0, len(classes)])).forward()[0], rel_tol=1e-9)


def test_memory_of_a_long_text_is_bounded():
    import tracemalloc

    model, tokens = tiny_model(4, 300), 3_000_000
    text = pa.array([" ".join(["alpha", "beta", "gamma delta"] * (tokens // 4))], pa.large_string())
    tracemalloc.start()
    for _, _, h, t, b in hmm.token_slices(text):
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        hmm.expected_counts(model, (h % np.uint64(300)).astype(np.uint16), b)
        beside = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert len(h) == tokens + 1 and beside < 110e6
    model_bytes = beside  # what a run needs does not grow with the text; 20 million tokens hold 20 * 10^6 * 19 bytes beside it
    assert model_bytes + 20e6 * 19 < 1e9


def test_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "`the.id` long, `the.text` string")
    assert {r[0]: r.n_tokens for r in hmm.score(docs, "the.id", "the.text", passes=-11).collect()} == {1: 3, 2: 1}
