import os
import random

import pytest

from loomspan.llm import tokens

tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER_PATH), reason="the vocabulary is missing")


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file(tokens.TOKENIZER_PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def samples():
    rng = random.Random(8)
    alphabet = "aAbe tT\n\t  0179.,'’-_ßéΔ语😀​﻿<|>"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(400)]
    long = ["ACGT" * 5000, "a" * 3001, "".join(rng.choice("ACGT") for _ in range(8000)), "aaab" * 700, " " * 5000, "word " * 20_000, "ß" * 2000]
    return [None, "", " ", "\n", "<|endoftext|>", "I'LL 'RE don'T we'VE", "café / naïve", *long, *made, *made[:20]]


def test_equals_public_library(spark, public):
    texts = samples()
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "x", "", "")], "doc_id bigint, text string, key string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_texts(df).collect()}
    assert [got[i] for i in range(len(texts))] == public(texts) and got[None] == public(["x"])[0]
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df).collect()}
    assert all(counts[i] == len(x) for i, x in got.items())


def test_documents(spark, data, public):
    from loomspan.session import table

    docs = table(spark, data, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_texts(table(spark, data, "documents")).collect()}
    assert [got[r["doc_id"]] for r in docs] == public([r["text"] for r in docs])


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokens.encode_texts(df).count() == 0


def test_bounded_matrices(public, monkeypatch):
    monkeypatch.setattr(tokens, "MATRIX_CELLS", 64)
    encoder = tokens.Encoder(tokens.load_vocabulary())
    texts = samples()[:60]
    ids, lengths = encoder.encode(texts)
    assert ids.tolist() == [x for t in public(texts) for x in t] and lengths.tolist() == [len(t) for t in public(texts)]


def test_long_pieces(public, monkeypatch):
    """Pieces merged by themselves give the ids that the public library gives; a piece of a million signs ends soon."""
    import time

    vocabulary = tokens.load_vocabulary()
    texts = ["ACGT" * 5000, "a" * 9001, "".join(random.Random(2).choice("ACGTacgtn") for _ in range(30_000)), "aaab" * 3000, " " * 12_000, "ß" * 6000]
    began = time.time()
    ids, _ = tokens.Encoder(vocabulary).encode(["x" * 1_000_000])
    assert time.time() - began < 60 and ids.tolist() == public(["x" * 1_000_000])[0]
    ids, _ = tokens.Encoder(vocabulary).encode(texts)
    assert ids.tolist() == [x for t in public(texts) for x in t]
    monkeypatch.setattr(tokens, "LONG_PIECE", 1)
    ids, _ = tokens.Encoder(vocabulary).encode(samples()[:120])
    assert ids.tolist() == [x for t in public(samples()[:120]) for x in t]
