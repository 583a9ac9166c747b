"""Neighbours against all pairs, and an embedding that keeps clusters apart."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.operators import manifold

SCHEMA = "reference_name string, id string, points array<struct<pos:int,mut:string>>, extra int"


def _clusters(clusters, members, seed=0):
    rnd = random.Random(seed)
    rows = []
    for c in range(clusters):
        base = {rnd.randrange(900): rnd.choice("ACGT") for _ in range(14)}
        for m in range(members):
            own = dict(base) | {rnd.randrange(900): rnd.choice("ACGT") for _ in range(rnd.randint(0, 3))}
            for p in rnd.sample(sorted(own), 2):
                del own[p]
            rows.append(("r", f"{c}:{m}", [(p, own[p]) for p in sorted(own)], c))
    rnd.shuffle(rows)
    return rows


def _apart(a, b):
    a, b = dict(a or ()), dict(b or ())
    return sum(a.get(p) != b.get(p) for p in a.keys() | b.keys())


@pytest.fixture(scope="module")
def table(spark):
    return _clusters(10, 60)


def test_neighbours_are_the_nearest(spark, table):
    k = 8
    got = manifold.neighbours(spark.createDataFrame(table, SCHEMA).repartition(5), k).collect()
    points = {r[1]: r[2] for r in table}
    found: dict[str, list[int]] = {}
    for r in got:
        assert r.id != r.neighbour and r.distance == _apart(points[r.id], points[r.neighbour])
        found.setdefault(r.id, []).append(r.distance)
    assert len({(r.id, r.neighbour) for r in got}) == len(got) == k * len(points)
    hits = 0
    for a in points:
        edge = sorted(_apart(points[a], points[b]) for b in points if b != a)[k - 1]
        hits += sum(d <= edge for d in found[a])
    assert hits >= 0.9 * k * len(points)


def test_small_and_odd_groups_give_all_pairs(spark):
    rows = [("a", "x", [(1, "A")], 0), ("a", "y", None, 0), ("a", "y", [], 0), ("a", None, [(1, "C"), (2, "G")], 0), (None, "x", [(1, "A")], 0), (None, "z", [(None, "A"), (3, None)], 0), ("alone", "x", [], 0)]
    got = manifold.neighbours(spark.createDataFrame(rows, SCHEMA), 10).collect()
    assert sorted((str(r.reference_name), str(r.id), str(r.neighbour), r.distance) for r in got) == sorted(
        [("a", "x", "y", 1), ("a", "y", "x", 1), ("a", "x", "None", 2), ("a", "None", "x", 2), ("a", "y", "None", 2), ("a", "None", "y", 2), ("None", "x", "z", 1), ("None", "z", "x", 1)]
    )
    assert manifold.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_node_that_all_others_hold(spark):
    """A wild type beside many single changes: lists stay short, and every node has its neighbours."""
    rows = [("r", "wt", [], 0)] + [("r", f"m{p}", [(p, "A")], 0) for p in range(400)]
    got = manifold.neighbours(spark.createDataFrame(rows, SCHEMA), 5)
    assert {r["count"] for r in got.groupBy("id").count().collect()} == {5}
    assert got.filter("id != 'wt' and neighbour = 'wt'").count() >= 0.9 * 400


@pytest.mark.parametrize("part", [manifold.PART, 150])
def test_clusters_stay_together(spark, table, monkeypatch, part):
    monkeypatch.setattr(manifold, "PART", part)
    df = spark.createDataFrame(table, SCHEMA)
    got = manifold.embed(df, rounds=6).collect()
    assert len(got) == len(table)
    y, label = np.array([(r.EMB1, r.EMB2) for r in got]), np.array([r.extra for r in got])
    d = ((y[:, None] - y) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    nearest = np.argsort(d, axis=1)[:, :5]
    assert (label[nearest] == label[:, None]).mean() > 0.95


def test_embedding_of_odd_tables(spark):
    rows = [("few", f"{k}", [(k, "A")], k) for k in range(9)] + [("more", f"{k % 12}", [(k % 12 // 4, "C")], k) for k in range(24)] + [("more", None, None, 1), (None, "x", [], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = manifold.embed(df, steps=45, rounds=3, dimensions=3)
    assert got.columns == [*df.columns, "EMB1", "EMB2", "EMB3"] and got.count() == len(rows)
    assert got.filter("EMB1 is null or EMB3 is null").count() == 10
    assert got.filter("EMB1 is not null").groupBy("reference_name", "id").agg(F.count_distinct("EMB1").alias("n")).filter("n <> 1").isEmpty()
    assert sorted(map(str, got.collect())) == sorted(map(str, manifold.embed(df.repartition(3), steps=45, rounds=3, dimensions=3).collect()))
    assert manifold.embed(df.limit(0)).count() == 0
