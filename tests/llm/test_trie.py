import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandframe.llm import queries, trie

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_turns(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}


def plain_rebuilt(rows):
    talks = plain_turns(rows)
    out = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = talks.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(talks):
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * size + sum(saved[p] for p in children[path])
        ends = ",".join(str(c) for c in sorted(members[path]) if len(talks[c]) == len(path))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def taken(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def of(spark, talks):
    """The trie of plain conversations."""
    rows = [(c, d, *t) for c, turns in talks.items() for d, t in enumerate(turns)]
    turns, convs = trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(3))
    missing = spark.createDataFrame([(c, 0) for c in talks if not talks[c]], "conv_id long, n long")
    return trie.prefix_trie(turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "key", "size"), convs.withColumnRenamed("turns", "n").unionByName(missing))


def made(n, seed):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 4 * n), n):
        for t in range(rnd.choice([0, 1, 2, 3, 6, 9, 14, 40])):
            rows.append((None if c == 3 else c, rnd.choice([t, t, t, None, 2 * t]), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "ä é", None, ""])))
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_rebuilt_conversations(spark, seed):
    rows = made(120, seed)
    got = taken(trie.prefix_trie(*trie.rebuild(spark.createDataFrame(rows, SCHEMA).repartition(3))))
    assert got == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("seed", [0, 1])
def test_few_letters_and_small_blocks(spark, seed, monkeypatch):
    for name, value in (("FIRST", 1), ("MOST", 4), ("RANGE", 1), ("RUN", 3), ("CHAIN", 2)):
        monkeypatch.setattr(trie, name, value)
    rnd = random.Random(seed)
    talks = {c: [("u", rnd.choice("ab")) for _ in range(rnd.randint(0, 12))] for c in range(150)}
    talks |= {1000 + c: [("u", "a")] * 20 for c in range(8)} | {2000: [("u", "a")] * 19, 2001: [("x", "é")] * 23, 7: []}
    assert taken(of(spark, talks)) == plain_trie(talks)


def test_copies_of_one_long_conversation_take_few_rounds(spark):
    talks = {c: [("user", f"turn {d}") for d in range(700)] for c in range(3)} | {9: [("user", f"turn {d}") for d in range(650)] + [("user", "end")]}
    assert taken(of(spark, talks)) == plain_trie(talks)
    assert [trie._last(b) for b in range(4)] == [4, 12, 28, 60] and trie._last(12) - trie._last(11) == trie.MOST


def test_cases(spark):
    extra = spark.createDataFrame([(5, 1, "user", "é", "k"), (5, None, None, None, "k"), (None, 0, "u", "x", "k"), (4, 0, "user", "é", "k")], SCHEMA + ", key string").withColumn("class", F.lit(1))
    rows = [tuple(r)[:4] for r in extra.collect()]
    assert taken(trie.prefix_trie(*trie.rebuild(extra))) == plain_trie(plain_rebuilt(rows))
    assert trie.prefix_trie(*trie.rebuild(extra.limit(0))).count() == 0
    assert taken(of(spark, {1: [("user", "word " * 300_000)]})) == plain_trie({1: [("user", "word " * 300_000)]})
    nodes = spark.createDataFrame([(4, 0), (4, 1)], "conv_id long, depth long")
    turns = spark.createDataFrame([(4, 1, "user", "é")], "conv_id long, depth long, role string, text string")
    assert sorted(map(tuple, trie.with_turns(nodes, turns).collect()), key=repr) == [(4, 0, None, None), (4, 1, "user", "é")]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert taken(queries.op11_prefix_trie(spark, sf)) == plain_trie(plain_rebuilt(rows))
