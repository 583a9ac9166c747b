"""Operators whose state is bounded give what the plain ones give."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandframe.operators import common, quantiles, sampling


@pytest.mark.parametrize("accuracy", [5, 100, 10_000])
@pytest.mark.parametrize("q", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_are_those_of_the_whole_groups(spark, accuracy, q):
    rnd = random.Random(accuracy)
    rows = [(g, rnd.choice([None, rnd.gauss(0, 1), float(rnd.randint(0, 5)), -0.0, 1e300])) for g in ("a", "b", None) for _ in range(700)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None), ("same", 7.0), *[("same", 7.0)] * 50]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: r.edge for r in quantiles.quantile(df, "x", q, ["g"], "edge", accuracy).collect()}
    want = {r.g: r.edge for r in df.groupBy("g").agg(F.percentile("x", F.lit(q)).alias("edge")).collect() if r.edge is not None}
    assert got == want
    assert [r.edge for r in quantiles.quantile(df, "x", q, None, "edge", accuracy).collect()] == [df.agg(F.percentile("x", F.lit(q))).first()[0]]


def test_a_sketch_that_misses_is_counted_in_full(spark, monkeypatch):
    monkeypatch.setattr(F, "percentile_approx", lambda x, ends, accuracy: F.array(F.max(x), F.max(x)))
    df = spark.range(101).select((F.col("id") * 2).alias("x"), (F.col("id") % 2).alias("g"))
    assert quantiles.quantile(df, "x", 0.3).first()[0] == 60.0
    assert {tuple(r) for r in quantiles.quantile(df, "x", 0.5, ["g"]).collect()} == {(0, 100.0), (1, 100.0)}


def test_quantile_filter(spark):
    df = spark.createDataFrame([("a", float(k)) for k in range(10)] + [("b", 5.0), ("b", None)], "g string, x double")
    assert sorted(r.x for r in common.keep_quantile(df, "x", 0.8, by=["g"]).collect()) == [5.0, 8.0, 9.0]
    assert sorted(r.x for r in common.keep_quantile(df, "x", 0.1, upper=False).collect()) == [0.0, 1.0]
    assert common.keep_quantile(df.limit(0), "x", 0.5).count() == 0
    with pytest.raises(ValueError):
        quantiles.quantile(df, "x", 1.5)


def test_copies_draw_on_their_own(spark):
    """How often each row is in samples of many seeds, against its share of the weight."""
    rows = [("copied", 1.0)] * 30 + [(f"r{k}", 1.0) for k in range(30)] + [("null", None), ("zero", 0.0)]
    df = spark.createDataFrame(rows, "name string, w double").repartition(3).cache()
    seeds, size = 60, 12
    counts, spread = Counter(), set()
    for seed in range(seeds):
        got = Counter(r.name for r in sampling.weighted_sample(df, size, "w", seed).collect())
        assert sum(got.values()) == size
        counts += got
        spread.add(got["copied"])
    # Half of all the equal weights: 6 of 12 on average, with a standard error of 0.2, and seldom the same number.
    assert abs(counts["copied"] / seeds - size / 2) < 0.8 and len(spread) > 4
    assert not counts["null"] and not counts["zero"]
    df.unpersist()


def test_samples_without_weights_and_of_odd_rows(spark):
    rows = [(None, [1]), ("", [1]), ("", [1]), ("x", None), ("x|1", [2])]
    df = spark.createDataFrame(rows, "a string, `b.c` array<int>")
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, sampling.weighted_sample(df, 10).collect())) == sorted(map(key, df.collect()))
    assert sampling.weighted_sample(df, 2).count() == 2 and sampling.weighted_sample(df, 0).count() == 0 and sampling.weighted_sample(df.limit(0), 3).count() == 0
    many = spark.range(100_000).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    assert sampling.weighted_sample(many, 7).count() == 7


def test_block_histograms_count_every_pair_once(monkeypatch):
    from strandframe.operators import distances

    monkeypatch.setattr(distances, "COLUMNS", 3)
    rnd = random.Random(2)
    rows = [(k, rnd.choice([1, 2, 1 << 28]), [(p, rnd.choice("ACG")) for p in range(12) if rnd.random() < 0.4]) for k in range(40)]
    rnd.shuffle(rows)
    for compat in (False, True):
        want = Counter({0: sum(c * (c - 1) // 2 for _, c, _ in rows)})
        for x in range(40):
            for y in range(x):
                (i, ci, a), (j, cj, b) = rows[x], rows[y]
                d = len({p for p, _ in a} | {p for p, _ in b}) - len(set(a) & set(b))
                want[d] += (ci if i > j else cj) if compat else ci * cj
        got = Counter()
        for part in (distances.histogram(rows[:15], rows[:15], True, compat), distances.histogram(rows[15:], rows[15:], True, compat), distances.histogram(rows[:15], rows[15:], False, compat)):
            for d, w in part.items():
                got[d] += w
        assert +got == +want


def test_rows_from_the_driver_are_a_lookup_side(spark):
    """References are few and their size unknown to the optimizer: no read may be shuffled by its reference."""
    from strandframe.operators import variants
    from strandframe.plans import synthetic as T

    assert "BroadcastHashJoin" in spark.range(9).join(common.small(spark.createDataFrame([(1,)], "id long")), "id")._jdf.queryExecution().executedPlan().toString()
    row = ("r", "refA", 0, 0, "60M", T.FORWARD[1], [30] * 60, None)
    reads = spark.createDataFrame([row], "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string")
    plan = variants.trim(reads, T.references(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_parts_of_reads_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    from strandframe.plans import synthetic as T

    spark.range(1, 3001).selectExpr("id as o_orderkey", "id % 90 as o_custkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(T, "PART", 1000)
    plan = T.reads(spark, str(tmp_path))
    sizes = [len(p) for p in plan.select("read_id").rdd.glom().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 600


def test_reads_of_one_genotype_are_not_shuffled_together(spark, sf):
    """Calls are written once, genotypes sent to them: neither a reference nor a genotype names the task of a read."""
    from strandframe.plans import registry

    plan = registry.queries()["seq_ids"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("aggregate") == 0


READ_QUERIES = [
    "genotype_best_quality", "genotype_rank", "indexed_selection", "sequence_counts", "selected_genotypes", "throughput", "mutation_calls", "cigar_fold",
    "mutation_stats", "aa_mutations_tidy", "nt_mutations_tidy", "position_profile", "conspicuous_positions",
]


@pytest.mark.parametrize("name", READ_QUERIES)
def test_reads_are_counted_before_they_are_shuffled(spark, sf, name, monkeypatch):
    """Above a scan of reads an aggregate comes first, or no shuffle at all but that by their own key: few references never name the task of a read."""
    from strandframe.plans import registry
    from strandframe.scratch import Scratch

    plans, save = [], Scratch.save
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(Scratch, "save", lambda self, df: plans.append(plan(df)) or save(self, df))
    # The reads of the test tables are few; nothing is sent around for its small size alone.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans.append(plan(registry.queries()[name](spark, sf)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    scans = 0
    for text in plans:
        above = []
        for line in text.splitlines():
            node = line.lstrip(" :+-")
            depth = len(line) - len(node)
            above = [(d, n) for d, n in above if d < depth] + [(depth, node)]
            if "FileScan parquet" in node and ("o_orderkey" in node or "read_id" in node):
                scans += 1
                met = [n for _, n in above if "Aggregate(" in n or ("Exchange hashpartitioning" in n and "REPARTITION" not in n)]
                assert not met or "Aggregate(" in met[-1], met[-1]
    assert scans
