import numpy as np

from strandframe.llm import embeddings as e


def brute(rows, threshold=0.93):
    links, comp = {}, {}
    good = {}
    for i, v, label in rows:
        links[i], comp[i] = 0, i
        if v is not None and label is not None and None not in v:
            x = np.array(v, float)
            if len(x) and np.isfinite(x).all() and x.any():
                x = x / np.abs(x).max()
                good[i] = (label, x / np.linalg.norm(x))
    ids = sorted(good)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            (la, x), (lb, y) = good[i], good[j]
            if la == lb and len(x) == len(y) and float(x @ y) >= threshold:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((comp[i], comp[j]))
                comp = {q: lo if c == hi else c for q, c in comp.items()}
    return {i: (links[i], comp[i], comp[i] == i) for i in links}


def made():
    rnd, rows = np.random.default_rng(0), []
    for group in range(40):
        base = rnd.standard_normal(16)
        for _ in range(8):
            rows.append((len(rows), (base + rnd.standard_normal(16) * rnd.choice([0.05, 0.25, 0.4])).tolist(), group % 3))
    rows += [(len(rows) + k, rows[3][1], rows[3][2]) for k in range(6)]
    odd = [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [1.0] * 8, [float("inf")] * 16, [1e300] * 16, [1e-300] * 16]
    return rows + [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, rows[3][1], None)]


def test_links_and_components_match_all_pairs(spark):
    rows = made()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e.near_vectors(df, tile=16, span=50).collect()}
    assert got == brute(rows)


def test_whole_small_table_matches_all_pairs(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e.near_vectors(df).collect()} == brute(rows)


def test_one_direction_and_hot_label(spark):
    rnd, base = np.random.default_rng(4), np.random.default_rng(5).standard_normal(24)
    rows = [(i, (base + rnd.standard_normal(24) * 0.01 * (1 + i % 60)).tolist(), int(i % 10 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e.near_vectors(df, tile=32, span=128).collect()} == brute(rows)


def test_groups_are_those_of_the_pairs():
    rnd = np.random.default_rng(6)
    for n in (5, 40, 300):
        i, j = (np.sort(rnd.integers(0, n, (2, n // 2)), axis=0)).tolist()
        pairs = sorted({(a, b) for a, b in zip(i, j, strict=True) if a != b})
        arrays = np.array(pairs, np.int64).reshape(-1, 2)
        links, first = e.group(n, iter([(arrays[::2, 0], arrays[::2, 1]), (arrays[1::2, 0], arrays[1::2, 1])]), np.ones(n), 0)
        comp = list(range(n))
        for a, b in pairs:
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if c == hi else c for c in comp]
        assert first.tolist() == comp and links.tolist() == [sum(v in p for p in pairs) for v in range(n)]


def test_bounds_hold():
    x = e.unit(np.random.default_rng(2).standard_normal((300, 64)))
    q, s, err = e.quantise(x)
    approx = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None]
    assert (np.abs(x @ x.T - approx) <= err[:, None] + err[None] + err[:, None] * err[None] + 1e-12).all()
    for threshold in (0.0, 0.2, 0.5):
        found = {(i, j) for a, b in e.tile_links(x, x, True, threshold, 64) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        want = {(i, j) for i in range(300) for j in range(i + 1, 300) if x[i] @ x[j] >= threshold}
        assert found == want


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, vec int, id int")
    assert e.near_vectors(df).count() == 0
    one = spark.createDataFrame([(None, [1.0, 2.0], 1, 1), (7, [1.0, 2.0], 1, 1)], "vec_id long, embedding array<double>, label int, vec int")
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in e.near_vectors(one).collect()) == [(-1, 0, True), (7, 0, True)]
