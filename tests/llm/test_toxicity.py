import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.llm import queries, toxicity


def score(lexicon, text):
    total, words = lexicon.evidence(text, lexicon.automaton())
    return float(lexicon.score(np.array([total]), np.array([float(words)]))[0])


def test_folding():
    assert toxicity.fold("L0SER, ídìоt").split() == ["ioser", "idiot"]
    assert toxicity.fold("ｓtup1d m0r0n! 5cum").split() == ["stupid", "moron", "scum"]
    assert toxicity.fold("a!diot").split() == ["aidiot"]


def test_exceptions_spare_only_what_lies_in_them():
    lexicon = toxicity.Lexicon({" trash ": 4.0, " idio": 5.0}, slope=2.0, offset=-3.0)
    assert score(lexicon, "put it in the trash can") == score(lexicon, "nothing here")
    assert score(lexicon, "put it in the trash  CAN, trash") > 0.5
    assert score(lexicon, "IDI0TS everywhere") > 0.5
    assert lexicon.evidence(None, lexicon.automaton()) == (0, 0)


def test_matches_are_those_of_plain_search():
    rnd = np.random.default_rng(1)
    lexicon = toxicity.Lexicon({" abca": 1.0, " abcab": 2.0, " ab ": 4.0, " b ": 0.5}, exceptions=())
    for _ in range(200):
        words = ["".join(rnd.choice(list("abc"), rnd.integers(1, 7))) for _ in range(rnd.integers(0, 12))]
        want = sum(max([w for e, w in lexicon.weights.items() if f" {x} ".startswith(e)], default=0.0) for x in words)
        assert lexicon.evidence(", ".join(words), lexicon.automaton()) == (want, len(words))


def test_held_out_quality(spark):
    sf = os.environ.get("TEST_QUALITY_DIR", "/root/testdata/sf0.1")
    got = queries.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    hit, miss, false, right = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0), n.get((0, 0), 0)
    assert hit / (hit + miss) > 0.85 and false / (false + right) < 0.01


def test_labels_outside_training_change_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.held_out("doc_id")
    a = toxicity.learn(docs, labels.filter(~out))
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, flipped.filter(~out)) == a


def plain_score(rows, weights, phrases, text):
    """Sum of the best entry of each word outside the phrases, and the number of words, by plain search."""
    parts = toxicity.fold(text or "").split()
    spared = set()
    for phrase in phrases:
        want = toxicity.fold(phrase).split()
        for x in range(len(parts) - len(want) + 1):
            if parts[x : x + len(want)] == want:
                spared.update(range(x, x + len(want)))
    best = lambda w: max((weights[e] for e in (f" {w} ", *(f" {w[:n]}" for n in range(4, len(w) + 1))) if e in weights), default=0.0)
    return sum(best(w) for x, w in enumerate(parts) if x not in spared), len(parts)


def test_learned_scores_are_those_of_a_plain_version(spark):
    rnd = np.random.default_rng(3)
    plain = [f"word{i}x" for i in range(60)] + ["great", "stuff"]
    bad = ["idiotic", "idiot", "moronic", "scumbag", "vermin"]
    rows, marks = [], []
    for i in range(600):
        words, toxic = [str(w) for w in rnd.choice(plain, rnd.integers(3, 40))], i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(rnd.integers(len(words))), str(rnd.choice(bad)))
        elif i % 60 == 1:
            words += ["vermin", "control"]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    rows += [(600, None), (601, ""), (602, "idiot " * 30_000)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert " ".join(toxicity.fold("vermin control").split()) in lexicon.exceptions
    sizes, held = Counter(y for _, y in marks), (Counter(), Counter())
    for (_, text), (_, y) in zip(rows, marks, strict=False):
        held[y].update(toxicity.entries_of(text))
    weights = {}
    for e, yes in held[1].items():
        w = math.log((yes + 0.5) / (sizes[1] + 1)) - math.log((held[0][e] + 0.5) / (sizes[0] + 1))
        longer = max((n for o, n in held[1].items() if o != e and o.startswith(e) and n >= 4 and n * 4 > held[0][o]), default=0)
        if yes >= 4 and yes * 4 > held[0][e] and w >= 3 and yes >= 0.006 * sizes[1] and (e.endswith(" ") or yes > 1.1 * longer):
            weights[e] = w
    assert set(lexicon.weights) == set(weights) and all(abs(lexicon.weights[e] - w) < 1e-12 for e, w in weights.items())
    got = {r.doc_id: r for r in toxicity.scores(docs, lexicon).collect()}
    for i, text in rows:
        total, words = plain_score(rows, weights, lexicon.exceptions, text)
        z = lexicon.offset + lexicon.slope * total / max(words, 1) ** lexicon.power
        assert (got[i].words, round(got[i].total, 6)) == (words, round(total, 6))
        assert abs(got[i].score - 1 / (1 + math.exp(-min(30, max(-30, z))))) < 1e-9
    x = np.array([plain_score(rows, weights, lexicon.exceptions, t) for _, t in rows[:600]], float)
    y = np.array([m for _, m in marks], float)
    loss = lambda a, b: np.mean(np.log1p(np.exp(-(2 * y - 1) * (a * x[:, 0] / x[:, 1] ** lexicon.power + b))))
    here = loss(lexicon.slope, lexicon.offset)
    assert all(here <= loss(lexicon.slope + a, lexicon.offset + b) + 1e-3 for a in (-0.5, 0, 0.5) for b in (-0.5, 0, 0.5))


def test_repeated_rows_of_one_id_teach_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "bad bad")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (1, 0)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels, support=1).weights == toxicity.learn(docs.filter("doc_id = 2 or text = 'text 0'"), labels, support=1).weights


@pytest.mark.parametrize("marks", [[], [(1, 1)], [(1, 0), (2, None)], [(9, 1), (None, 0)]])
def test_odd_labels_and_rows(spark, marks):
    docs = spark.createDataFrame([(1, "bad idiot", "x"), (2, None, "y"), (None, "", "z"), (1, "bad idiot", "x")], "doc_id long, text string, total string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    got = toxicity.scores(docs, lexicon).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.drop_toxic(docs, lexicon).columns == docs.columns
    assert toxicity.scores(docs.limit(0), lexicon).count() == 0
