"""Every operator on tables whose other columns bear the names that operators use, with nulls, repeats, and no rows."""

import pytest

import corpus_pipeline
from strandframe.llm import decontam, embeddings, hmm, licenses, lines, minhash, mixing, sharding, toxicity, warc

CLASHING = [
    "__size", "__source_size", "__target", "__quota", "__taken", "__by_shard", "__lines", "__removed", "__clean", "__license", "__digest", "__notices",
    "__key", "__b", "__gone", "__at", "__slot", "__shard", "__text", "__row", "__bad", "__left", "shard", "slot", "_x", "_xkey", "_xs", "_xb", "_XID", "id", "key",
    "row", "h", "s", "t", "c", "n", "keys", "sketch", "items", "score", "predicted", "total", "words", "y", "entry", "component", "component_id", "kept",
    "out", "codes", "digest", "vec", "label2", "width", "range", "head", "copies", "file", "start", "size", "value", "a.b",
]
TEXT = "one two three four five six seven\nReleased under the MIT License.\n"
ROWS = [(1, TEXT, "a"), (1, TEXT, "a"), (2, TEXT + " x", "b"), (None, None, None), (3, "", None), (None, "some text " * 5000, "b")]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, "en", 1, *(f"{c} {k}" for c in CLASHING)) for k, r in enumerate(ROWS)], schema).repartition(3)


def kept(df, outputs):
    """The clashing columns by their present names: those of outputs have moved."""
    return {c: f"{c}_in" if c in outputs else c for c in CLASHING if (f"{c}_in" if c in outputs else c) in df.columns}


OPERATORS = {
    "resample": (lambda d: mixing.resample(d, weigh=mixing.rotating), ()),
    "mix": (lambda d: mixing.mix(d, weigh=mixing.rotating), mixing.OUTPUTS),
    "clean": (lambda d: lines.clean(d, sites=2), ("__lines", "__removed", "__clean")),
    "scan": (licenses.scan, ("__license", "__digest", "__notices")),
    "place": (lambda d: sharding.place(d, slot_name="slot"), ("shard", "slot")),
    "keep_first": (minhash.keep_first, ()),
    "drop_toxic": (lambda d: toxicity.drop_toxic(d, toxicity.Lexicon({" bad ": 3.0}, offset=-3.0)), ()),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_other_columns_are_kept(docs, name):
    run, outputs = OPERATORS[name]
    got = run(docs)
    names = kept(got, outputs)
    assert sorted(names) == sorted(CLASHING) and len(set(got.columns)) == len(got.columns)
    rows = got.collect()
    assert rows and all(len({r[names[c]][len(c) :] for c in CLASHING}) == 1 and all(r[names[c]].startswith(c) for c in CLASHING) for r in rows)
    assert run(docs.limit(0)).count() == 0


def test_contaminated_rows_go_and_columns_stay(spark, docs):
    items = spark.createDataFrame([(1, "one two three four five six", "x"), (None, None, None)], "item_id long, text string, id string")
    got = decontam.drop_contaminated(docs, items)
    assert got.columns == docs.columns and sorted(r.text or "" for r in got.collect()) == ["", "", "some text " * 5000]
    assert len(decontam.contaminated(docs, items).collect()) == 3


def test_operators_that_ignore_other_columns(spark, docs):
    assert len(minhash.near_duplicates(docs).collect()) == len(hmm.score(docs).collect()) == len(ROWS)
    assert len(toxicity.scores(docs, toxicity.Lexicon({})).collect()) == len(ROWS)
    labels = spark.createDataFrame([(1, 1, 1), (3, 0, 1), (None, None, None)], "doc_id long, toxic int, y int")
    assert toxicity.learn(docs, labels, support=1) and toxicity.learn(docs.limit(0), labels.limit(0)).weights == {}
    pages = docs.withColumnsRenamed({"doc_id": "page_id", "text": "html", "lang": "url"})
    assert sorted(r.payload_bytes for r in warc.round_trip(pages).collect()) == sorted(len((t or "").encode()) for _, t, _ in ROWS)
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 1, "a", "b", "c"), (None, None, None, None, None, None)], "vec_id long, embedding array<float>, label int, digest string, vec string, code string")
    assert len(embeddings.near_vectors(vectors).collect()) == 2
    assert hmm.score(docs.limit(0)).count() == 0 and minhash.near_duplicates(docs.limit(0)).count() == 0


def test_pipeline_with_odd_rows_and_empty_tables(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    empty = {"labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, table in (("some", plain), ("none", plain.limit(0))):
        table.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        for other, schema in empty.items():
            spark.createDataFrame([], schema).write.parquet(f"file://{tmp_path}/{name}/{other}.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}/some").collect()
    assert {r.text for r in got} <= {TEXT, "some text " * 5000} and all(r.shard for r in got)
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0
