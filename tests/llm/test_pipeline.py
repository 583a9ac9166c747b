"""The pipeline against a plain version of every stage on the small tables."""

import hashlib
from collections import Counter

import corpus_pipeline
from strandframe.llm import sharding, toxicity
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_minhash import brute as groups


def test_stages_match_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, sf)
        rows = [r.asDict() for r in left.collect()]
        left = spark.createDataFrame([tuple(r.values()) for r in rows], left.schema)
        seen[name] = rows
        if name != "sharding":
            assert left.columns == docs.columns
    start = [r.asDict() for r in docs.collect()]
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet").filter(~toxicity.held_out("doc_id")))
    bad = {r.doc_id for r in toxicity.scores(docs, lexicon).filter("predicted = 1").collect()}
    assert bad and {r["doc_id"] for r in seen["toxicity"]} == {r["doc_id"] for r in start} - bad
    comp = groups([(r["doc_id"], r["text"]) for r in seen["toxicity"]])
    assert sorted(r["doc_id"] for r in seen["near_dedup"]) == sorted(set(comp.values()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in seen["near_dedup"]], items)}
    assert {r["doc_id"] for r in seen["decontamination"]} == {r["doc_id"] for r in seen["near_dedup"]} - hit
    kept = {r["doc_id"]: r for r in seen["decontamination"]}
    times = Counter(r["doc_id"] for r in seen["mixing"])
    assert set(times) <= set(kept) and max(times.values()) <= 3 and all(r == kept[r["doc_id"]] for r in seen["mixing"])
    table = sharding.fill(sharding.SHARDS, sharding.SLOTS)
    assert len(seen["sharding"]) == len(seen["mixing"])
    for r in seen["sharding"]:
        slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert r["shard"] == sharding.SHARDS[table[slot]]


def test_run_is_the_stages_in_order(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard"} == set(out.columns)
    assert out.count() > 0
