import random
import time
import re

import numpy as np
import pytest

from strandframe.llm import decontam

SPLIT = re.compile(r"[\s!-/:-@\[-`{-~]+", re.A)


def words_of(text):
    return [w for w in SPLIT.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def plain_distance(item, text):
    """Smallest edit distance of item to any run of text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (w != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def row_distance(item, text):
    """plain_distance, a row of the table at a time."""
    ramp = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != w))
        new[0] = i + 1
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def brute(docs, items, rate=0.2):
    number, out = {}, {}
    as_numbers = lambda text: np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.int64)
    wanted = [(i, as_numbers(item)) for i, item in items]
    for d, text in docs:
        have = as_numbers(text)
        for i, want in wanted:
            if len(want) and len(have) and (n := row_distance(want, have)) <= int(rate * len(want) + 1e-9):
                out[d, i] = n
    return out


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        p, kind = rnd.randrange(len(words)), rnd.randrange(3)
        words[p : p + (kind > 0)] = [] if kind == 1 else [f"new{rnd.randrange(999)}"]
    return words


def test_closest_is_the_plain_distance():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        item, text = rnd.integers(0, 6, rnd.integers(1, 9)).astype(np.uint64), rnd.integers(0, 6, rnd.integers(1, 15)).astype(np.uint64)
        d, s, e = decontam.closest(item, text)
        assert d == plain_distance(item.tolist(), text.tolist()) == row_distance(item, text) and 0 <= s <= e <= len(text)
        best = [0] if s == e else [plain_distance(item.tolist(), text[s:e].tolist())]
        assert best[0] <= d or s == e


def test_edited_passages_are_found_and_nothing_else(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["the"] * 60
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(12, 60)))) for i in range(30)]
    docs = []
    for d in range(400):
        text = [rnd.choice(vocab) for _ in range(rnd.randrange(5, 200))]
        if d % 2:
            i, item = items[d % 30]
            k = int(0.2 * len(item.split()))
            at = rnd.randrange(len(text))
            text[at:at] = edited(rnd, item.split(), rnd.randint(0, k))
        docs.append((d, ". ".join(text).upper() if d % 5 == 0 else "\n".join(text)))
    docs += [(1000, None), (1001, ""), (1002, "the " * 3000), (1003, items[3][1]), (1003, items[3][1])]
    items += [(100, None), (101, ""), (102, " .. "), (103, "the the")]
    df = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, item_id int").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated(df, it).collect()}
    want = brute(docs, [(i, t) for i, t in items if t])
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want)
    blocks = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, it, block=7).collect()}
    assert blocks == set(got)


def test_whole_small_table_matches_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated(docs, items).collect()}
    assert max(len(t or "") for _, t in rows) > 6000
    assert got == brute(rows, [(r.item_id, r.text) for r in items.collect()])


def test_very_long_texts_are_searched_whole(spark):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(40))) for i in range(6)]
    text = [rnd.choice(vocab) for _ in range(300_000)]
    for i, item in items[:5]:
        at = 50_000 * (i + 1)
        text[at : at + 40] = edited(rnd, item.split(), 6)
    docs = [(1, " ".join(text)), (1, " ".join(text)), (2, "x" * 3_000_000)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.distance) for r in decontam.contaminated(df, it).collect()]
    want = brute(docs[:1], items)
    assert len(got) == 10 and set(got) == {(d, i, n) for (d, i), n in want.items()}


def test_dropping_keeps_clean_rows_and_empty_tables(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, "a"), (2, "clean text", "b"), (None, item, "c"), (None, "clean", None), (3, None, None)], "doc_id long, text string, id string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    left = decontam.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.text or "" for r in left.collect()) == ["", "clean", "clean text"]
    assert decontam.drop_contaminated(docs.limit(0), items).count() == 0
    assert decontam.drop_contaminated(docs, items.limit(0)).count() == 5
    many = spark.createDataFrame([(i, f"{item} {i}") for i in range(9)], "item_id long, text string")
    assert decontam.drop_contaminated(docs, many, block=2).count() == decontam.drop_contaminated(docs, many, block_bytes=60).count() == 3
    same = spark.createDataFrame([(1, item), (1, "other"), (1, "other")], "doc_id long, text string")
    assert [r.text for r in decontam.drop_contaminated(same, items).collect()] == ["other"] * 2


class Candidates(decontam.ItemIndex):
    """Takes every candidate pair as found."""

    def _verify(self, words, bounds, row, x, s, best):
        best[row, x] = (0, s, s)


def found_share(n, items=300, recall=0.99):
    """Share of items of n random words that are candidates in a text with the most edits allowed."""
    rnd = random.Random(n)
    fresh = lambda count: [rnd.getrandbits(62) | 1 for _ in range(count)]
    every = [(i, np.array(fresh(n), np.uint64)) for i in range(items)]
    # Items too short for edits come first; they must not settle the repetitions of the others.
    short = [(-i, np.array(fresh(3), np.uint64)) for i in range(1, 41)]
    index = Candidates(short + every, 0.2, recall)
    hits = 0
    for i, item in every:
        words = item.tolist()
        for _ in range(n // 5):
            p, kind = rnd.randrange(len(words)), rnd.randrange(3)
            words[p : p + (kind > 0)] = [] if kind == 1 else fresh(1)
        text = np.array(fresh(40) + words + fresh(40), np.uint64)
        hits += any(index.items[x][0] == i for _, x, *_ in index.search(text, np.array([0, len(text)])))
    return hits / items


def test_every_length_reaches_the_recall_at_the_most_edits():
    assert min(found_share(n) for n in (15, 30, 50)) >= 0.98


def test_lengths_beyond_the_repetitions_verify_all_windows(monkeypatch):
    monkeypatch.setattr(decontam, "enough", lambda n, k, recall: None)
    assert found_share(60, items=100) == 1


@pytest.mark.parametrize("n", [5, 15, 25, 40, 60, 100, 200])
def test_unrelated_windows_rarely_collide_in_any_repetition(n):
    rnd = np.random.default_rng(n)
    items, windows = (rnd.integers(1, 1 << 62, (400, n)).astype(np.uint64) for _ in range(2))
    # Half of the places hold one of 50 words, as texts do.
    common = rnd.integers(1, 1 << 62, 50).astype(np.uint64)
    for part in (items, windows):
        usual = rnd.random(part.shape) < 0.5
        part[usual] = rnd.choice(common, int(usual.sum()))
    for r in range(decontam.repetitions(n, 0.2, 0.99) or 48):
        a, b = decontam.lsh_key(items, r, decontam._ITEM_PAD), decontam.lsh_key(windows, r, decontam._PAD)
        assert (a[:, None] == b).mean() < 0.01


def test_selective_repetitions_alone_reach_the_recall():
    for n in (25, 40, 60, 100):
        assert decontam.repetitions(n, 0.2, 0.99) is not None and found_share(n, items=150) >= 0.98


def test_unrelated_texts_are_hardly_verified():
    class Counting(decontam.ItemIndex):
        checks = 0

        def _verify(self, *rest):
            self.checks += 1
            super()._verify(*rest)

    rnd = np.random.default_rng(1)
    vocab = rnd.integers(1, 1 << 62, 30).astype(np.uint64)
    make = lambda: rnd.choice(vocab, 25)
    index = Counting([(i, make()) for i in range(200)], 0.2, 0.99)
    texts = [make() for _ in range(200)]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    found, _ = index.windows(np.concatenate(texts), bounds)
    began = time.time()
    list(index.search(np.concatenate(texts), bounds))
    tried = sum(len(v) for v in found.values()) * 200
    assert index.checks < 0.02 * index.repetitions[25] * max(tried, 1) and time.time() - began < 20
