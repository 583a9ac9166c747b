import re
from collections import defaultdict

import numpy as np

from strandframe.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_sainte_lague(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
        held[best] += 1
    return held


def test_apportionment_is_that_of_one_by_one_awards():
    rnd = np.random.default_rng(0)
    for trial in range(300):
        votes = rnd.integers(0, 50 if trial % 2 else 5, rnd.integers(1, 30)).astype(float) ** (1 + trial % 4)
        for seats in (0, 1, 2, 7, 40, 333):
            assert mixing.sainte_lague(votes, seats).tolist() == plain_sainte_lague(votes, seats)


def test_shard_quotas_are_integers_that_add_up():
    votes = np.array([5.0, 3.0, 1.0, 0.0, 11.0])
    quotas = mixing.shard_quotas(votes, 103, 10)
    assert quotas.shape == (10, 5) and (quotas >= 0).all()
    assert set(quotas.sum(axis=1).tolist()) == {10, 11}
    assert quotas.sum(axis=0).tolist() == plain_sainte_lague(votes, 103)


def test_words_taken_by_shard_are_the_quotas(spark):
    sizes = {"a": 64 * 40, "b": 64 * 9, "c": 64 * 25}
    rows = [(i, "w " * 32, s) for s, n in sizes.items() for i in range(n // 32)]
    docs = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    weights = {"a": 1.0, "b": 2.0, "c": 3.0}
    goal = mixing.targets(np.array([*sizes.values()]), np.array([*weights.values()]), sum(sizes.values()), 3)
    quotas = mixing.shard_quotas(goal, round(goal.sum() / 64), 16)

    def run(seed):
        got = mixing.mix(docs, weights, seed=seed).collect()
        by = {s: np.sum([r["__by_shard"] for r in got if r.source == s], axis=0).tolist() for s in sizes}
        assert all(sum(r["__by_shard"]) == r["__taken"] for r in got)
        return by, {r.doc_id: r["__taken"] for r in got}

    (by, one), (_, two) = run(1), run(2)
    assert by == {s: (quotas[:, x] * 64).tolist() for x, s in enumerate(sizes)}
    assert one != two and sum(one.values()) == sum(two.values()) and run(1)[1] == one


def test_the_order_of_blocks_is_a_seeded_permutation():
    for blocks in (1, 2, 7, 100, 4097):
        orders = [[(k * step + shift) % blocks for k in range(blocks)] for step, shift in (mixing._order("s", blocks, seed) for seed in (1, 2, 3))]
        assert all(sorted(o) == list(range(blocks)) for o in orders)
    assert len({tuple(o) for o in orders}) == 3


def test_targets_stop_at_the_cap_and_share_the_excess():
    got = mixing.targets(np.array([100, 10, 1000, 0]), np.array([1.0, 5.0, 2.0, 9.0]), 1110, 3)
    assert got[1] == 30 and got[3] == 0 and abs(got.sum() - 1110) < 1e-9
    assert abs(got[0] - 300) < 1e-9 and abs(got[2] - 780) < 1e-9


def by_source(rows, sizes):
    total = defaultdict(int)
    for i, _, s in rows:
        total[s] += sizes[i]
    return total


def test_mix_takes_what_the_targets_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = {r.doc_id: r for r in queries.op2_mixing(spark, sf).collect()}
    again = {r.doc_id: r for r in queries.op2_mixing(spark, sf).collect()}
    assert got == again and len(got) == len(rows)
    sizes = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    total = by_source(rows, sizes)
    order = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    goal = mixing.targets(np.array([total[s] for s in order]), np.array([weight[s] for s in order]), sum(total.values()), 3)
    goal = dict(zip(order, goal, strict=True))
    taken = defaultdict(int)
    for i, _, s in rows:
        r = got[i]
        assert (r["size"], r.source_size) == (sizes[i], total[s])
        assert abs(r.target - goal[s]) < 1e-6 and 0 <= r.taken <= 3 * sizes[i]
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 3 * 64


def test_odd_rows_and_whole_documents(spark):
    rows = [(i, "w " * (i % 7), ["a", "b", None][i % 3], "k") for i in range(300)]
    rows += [(None, "x y", "a", "k"), (5, "dup dup", "b", "k"), (5, "dup dup", "b", "k"), (900, None, "c", None), (901, "", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, s string").repartition(3)
    got = mixing.mix(docs, weights={"a": 1.0, "b": 2.0, None: 3.0, "c": 4.0}).collect()
    assert len(got) == len(rows) and all(r["__taken"] == 0 for r in got if r.source == "c")
    total = sum(r["__size"] for r in got)
    assert abs(sum(r["__taken"] for r in got) - total) < 3 * 64
    same = spark.createDataFrame([(7, "same words here", "a")] * 400 + [(i, "x y z", "b") for i in range(400)], "doc_id long, text string, source string")
    copies = [r.source for r in mixing.resample(same, weigh=mixing.rotating).collect()]
    assert abs(copies.count("a") - 800 / 3) < 64 and abs(copies.count("b") - 1600 / 3) < 64
    whole = mixing.resample(docs, weigh=mixing.rotating)
    assert whole.columns == docs.columns
    words = sum(len(WORD.findall(r.text)) for r in whole.collect())
    assert abs(words - total) < 0.15 * total
    assert mixing.mix(docs.limit(0), weigh=mixing.rotating).count() == 0


def test_sums_of_floors_and_counts_of_words_are_those_of_listed_blocks():
    rnd = np.random.default_rng(5)
    for _ in range(400):
        n, m, a, b = (int(rnd.integers(lo, 60)) for lo in (0, 1, 0, 0))
        got = mixing.floor_sums(*(np.array([x], np.int64) for x in (n, m, a, b)))
        assert got[0] == sum((a * i + b) // m for i in range(n))
    for _ in range(300):
        width, blocks = int(rnd.integers(1, 6)), int(rnd.integers(1, 40))
        size = width * blocks - int(rnd.integers(0, width))
        step, shift = mixing._order("s", blocks, int(rnd.integers(0, 99)))
        lo, hi = sorted(int(x) for x in rnd.integers(0, size + 1, 2))
        reach = np.sort(rnd.integers(0, 3 * blocks + 1, 4))
        want = [sum(((q - (w // width * step + shift) % blocks) + blocks - 1) // blocks for w in range(lo, hi)) for q in reach.tolist()]
        got = mixing.words_taken([lo], [hi], [width], [blocks], [step], [shift], reach[None, :])
        assert got[0].tolist() == want
    # A text of 10^9 words in a line of 10^13: no block is listed, and half of the order takes about half of it.
    blocks = 10**13 // 64
    step, shift = mixing._order("s", blocks, 1)
    half = mixing.words_taken([5 * 10**12], [5 * 10**12 + 10**9], [64], [blocks], [step], [shift], np.array([[blocks // 2, blocks]]))[0]
    assert abs(half[0] - 5 * 10**8) < 10**7 and half[1] == 10**9


def test_small_sources_come_near_their_targets(spark):
    def check(sizes):
        rows = [(k, "w " * n, f"s{k:02d}") for k, n in enumerate(sizes)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        got = mixing.mix(docs, weigh=mixing.rotating).collect()
        assert len(got) == len(rows)
        for r in got:
            assert abs(r["__taken"] - r["__target"]) <= max(8, 0.1 * r["__target"]), r
            assert 0 <= r["__taken"] <= 3 * r["__size"] and sum(r["__by_shard"]) == r["__taken"]

    check([50] * 40)
    check([30, 10, 25])
    check([100_000, 3, 700, 20])


def test_equal_rows_share_one_stretch(spark, monkeypatch):
    rows = [(7, "same words here too", "a")] * 900 + [(i, "x y z", "b") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)

    def run():
        got = mixing.mix(docs, weigh=mixing.rotating, columns=["doc_id"]).collect()
        assert len(got) == len(rows)
        for size in (4, 3):
            some = [r for r in got if r["__size"] == size]
            assert abs(sum(r["__taken"] for r in some) - some[0]["__target"]) <= 64 and max(r["__taken"] for r in some) <= 3 * size
        return sorted((r.doc_id, r["__taken"]) for r in got)

    whole = run()
    monkeypatch.setattr(mixing, "MANY_EQUAL", 100)
    assert run() == whole
