import random

import numpy as np
import pytest

from strandframe.llm import queries, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    return tokens.load(PATH)


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def plain_merge(word, merges):
    """One pair at a time, the lowest rank first, from the left."""
    parts = [int(merges.first[b]) for b in word]
    while len(parts) > 1:
        ranks, merged = merges.look_up(np.array(parts[:-1]), np.array(parts[1:]))
        k = int(ranks.argmin())
        if ranks[k] == tokens._NONE:
            break
        parts[k : k + 2] = [int(merged[k])]
    return len(parts)


def made(n, seed=0):
    rnd = random.Random(seed)
    alphabets = ["abcdefgh etaoin", "aaaa ", "0123456789 .,", "'s't're've'm'll'd I", "äöüßéèñ çœ", "日本語 中文字", "\x1c\x1f\x0b\x00_~", "\t\n\r   　", "🎉👍🏽é x", "مرحبا بالعالم", "͸ᫎ꟎\U0001df2b\U0003fc3f a1!"]
    return ["".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.choice([0, 1, 5, 50, 400]))) for _ in range(n)]


def test_counts_are_those_of_the_library(library, merges):
    texts = made(400) + ["", " ", "  ", "a" * 5000, "ab" * 3000, "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "x" * 31 + "\n\n  y"]
    assert tokens.Counter(merges).counts(iter(texts), len(texts)).tolist() == wanted(library, texts)


def test_rounds_merge_as_one_by_one(merges):
    rnd = random.Random(1)
    words = [bytes(rnd.choice(b"aabe \xc3\xa9") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    assert tokens.symbols_left(words, merges).tolist() == [plain_merge(w, merges) for w in words]
    assert tokens.symbols_left([], merges).tolist() == []


@pytest.mark.parametrize("window", [4, 7, 16, 100])
def test_windows_end_between_pre_tokens(library, window):
    for text in made(60, 2) + ["we're they'll I'd 'll  '' 've " * 20, " " * 100 + "x", "a" * 500]:
        whole = [w for part in tokens.pre_tokens(text) for w in part]
        assert [w for part in tokens.pre_tokens(text, window) for w in part] == whole
        assert whole == [text[a:b] for _, (a, b) in tokens._cutters()[3].pre_tokenize_str(text)]


def test_memory_of_pre_tokens_is_bounded(library, merges, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    monkeypatch.setattr(tokens, "SLICE", 50)
    monkeypatch.setattr(tokens, "WINDOW", 40)
    texts, counter = made(100, 3), tokens.Counter(merges)
    assert counter.counts(iter(texts), len(texts)).tolist() == wanted(library, texts)
    assert len(counter.known) < 200


def test_cases(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "naïve café", "y"), (None, "a <|endoftext|>", None), (4, "word " * 300_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __tokens string").withColumnRenamed("__tokens", "__Tokens").repartition(3)
    got = tokens.count(docs, PATH)
    assert got.columns == ["doc_id", "text", "__Tokens_in", "__bytes", "__tokens"]
    want = sorted(((i, len((t or "").encode()), n) for (i, t, _), n in zip(rows, wanted(library, [t or "" for _, t, _ in rows]), strict=True)), key=repr)
    assert sorted(((r.doc_id, r["__bytes"], r["__tokens"]) for r in got.collect()), key=repr) == want
    assert tokens.count(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        tokens.load(public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: (len((d.text or "").encode()), n, n > 1024) for d, n in zip(docs, wanted(library, [d.text or "" for d in docs]), strict=True)}
    got = queries.op13_token_counts(spark, sf).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == want
