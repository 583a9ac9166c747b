import random

from strandframe.llm._graph import components
from strandframe.llm._store import Scratch, ready


def plain(edges):
    comp = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        comp.setdefault(a, a)
        comp.setdefault(b, b)
        lo, hi = sorted((comp[a], comp[b]))
        if lo != hi:
            comp = {k: lo if c == hi else c for k, c in comp.items()}
    return comp


def test_components_of_chains_stars_cycles_and_noise(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + k) for k in range(1, 40)] + [(900, 901), (901, 902), (902, 900)]
    edges += [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)] + [(7, 7), (None, 3), (4, None), (900, 901)]
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()
    assert {r.id: r.component for r in got} == plain(edges) and len(got) == len(plain(edges))


def test_no_edges_and_own_settings(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "5m")
        ready(spark)
        assert spark.conf.get(key) == "5m"
    finally:
        spark.conf.set(key, old)
