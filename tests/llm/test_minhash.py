import random
import re
from itertools import combinations

import numpy as np

from strandframe.llm import _words, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """(doc_id, text) -> {doc_id: component}, by all pairs."""
    sets = [(i, plain_set(t)) for i, t in rows]
    comp = {i: i for i, _ in sets}
    for (i, x), (j, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y) and comp[i] != comp[j]:
            lo, hi = sorted((comp[i], comp[j]))
            comp = {k: lo if c == hi else c for k, c in comp.items()}
    return comp


def made():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(6):
        text = [rnd.choice(vocab) for _ in range(60)]
        for _ in range(14):
            t = list(text)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(60)] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(t)))
    rows += [(1000 + i, t) for i, t in enumerate(["", None, "one two", "One\ttwo", "   ", "alone", "x " * 9000, "X\n" * 9000])]
    rows += [(5, rows[5][1]), (2000, rows[60][1] + " extra")]
    return rows


def test_words_are_split_and_lowered_like_the_pattern():
    texts = ["Ab cD\n\x0bE", "", "ab", "Éa b\x85c d", "a" * 700_000 + " b", " x "]
    for t in texts:
        want = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        got = _words.word_hashes(t)
        assert len(got) == len(want)
        assert len(set(got.tolist())) == len(set(want))
    assert _words.word_hashes("ab")[0] == _words.word_hashes("x AB y")[1]


def test_components_match_all_pairs(spark):
    rows = made()
    df = spark.createDataFrame(rows + [(None, "no id")], "doc_id long, text string").repartition(3)
    got = minhash.near_duplicates(df).collect()
    want = brute(rows)
    sizes = {i: len(plain_set(t)) for i, t in rows}
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
            continue
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], want[r.doc_id], r.doc_id == want[r.doc_id])


def test_chains_past_the_centre_are_found(spark):
    """Members too far from the smallest id that are linked with each other, and shortened copies."""
    rnd = random.Random(8)
    vocab = [f"v{i}" for i in range(900)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(150)]
        for _ in range(25):
            t = list(base)
            for _ in range(rnd.randint(0, 9)):
                t[rnd.randrange(150)] = rnd.choice(vocab)
            lo = rnd.randint(0, 25)
            rows.append((len(rows), " ".join(t[lo : 150 - rnd.randint(0, 25)])))
    passage = " ".join(rnd.choice(vocab) for _ in range(40))
    rows += [(1000 + i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 30))) + " " + passage) for i in range(60)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_whole_small_table_matches_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n long, id string")
    assert minhash.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c", 7, "k"), (2, "A b c", 8, "l"), (None, None, None, None)], "doc_id long, text string, n long, id string")
    kept = minhash.keep_first(docs).collect()
    assert sorted(r.n or 0 for r in kept) == [0, 7]


def test_rows_that_share_an_id_lose_no_differing_text(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    near = " ".join(base[:59]) + " other"
    rows = [(1, " ".join(base), "a"), (1, " ".join(base), "b"), (1, near, "c"), (1, " ".join(rnd.sample(base, 60)), "d"), (2, " ".join(base), "e"), (3, "x y", "f"), (3, "x z", "g")]
    rows += [(3, "x y", "h")] * 3 + [(4, None, "i"), (4, "", "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _xgone string").repartition(4)
    got = sorted((r.doc_id, r.text or "", r["_xgone"]) for r in minhash.keep_first(docs).collect())
    again = sorted((r.doc_id, r.text or "", r["_xgone"]) for r in minhash.keep_first(docs.repartition(2)).collect())
    assert got == again and {r[0] for r in got} == {1, 3, 4}
    assert len([r for r in got if r[0] == 1]) == 2 and {r[1] for r in got if r[0] == 3} == {"x y", "x z"} and len([r for r in got if r[0] == 3]) == 2
    assert {r[1] for r in got if r[0] == 1} & {rows[3][1]}


def test_long_words_that_polynomials_confuse_differ():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    assert _words.word_hashes(a)[0] != _words.word_hashes(b)[0]
    assert _words.word_hashes(a.upper())[0] == _words.word_hashes("q " + a)[1]


def test_circulant_signature_estimates_similarity():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 1 << 63, 1000).astype(np.uint64)
    y = np.concatenate([x[:800], rnd.integers(0, 1 << 63, 200).astype(np.uint64)])
    s = minhash.circulant_minhash(np.concatenate([x, y]), np.array([0, 1000, 2000]), 512)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.08
