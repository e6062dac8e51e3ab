import hashlib
import random

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import bpe
from reviewlens.llm.queries import tokenizer_path

PATH = tokenizer_path()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def check(text):
    encoder, decoder = bpe.loaded(PATH)
    ids = encoder.encode(text)
    want = library(text)
    assert ids.tolist() == want
    assert decoder.decode(ids).decode("utf-8", "replace") == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    check(text)


@pytest.mark.parametrize(
    "text", ["", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext", "a" * 5000, "ab" * 3000, " " * 3000 + "x", "\n\n \t x", "I'll it's 'tis", "日本語 😀😀‍", "\x00\x7f", "=-" * 900]
)
def test_awkward_texts(text):
    check(text)


def test_joined_tokens():
    encoder, _ = bpe.loaded(PATH)
    rng = random.Random(5)
    for _ in range(4000):
        check(b"".join(rng.choice(encoder.vocabulary.tokens) for _ in range(rng.randint(1, 5))).decode("utf-8", "ignore"))


def test_pair_table_is_what_merging_gives():
    encoder, _ = bpe.loaded(PATH)
    rng = random.Random(6)
    tokens = list(encoder.ids.values())
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        both = encoder.vocabulary.tokens[a] + encoder.vocabulary.tokens[b]
        assert encoder.compatible(a, b) == (encoder.merged([encoder.ids[both[k : k + 1]] for k in range(len(both))]) == [a, b])


def test_query_columns(docs):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "x y " * 50_000), (1, "Hello world"), (None, "é")]
    df = docs(rows, n_tokens="mine", token_ids=0)
    got = bpe.round_trip(df, PATH).collect()
    want = sorted(
        (str(i), len(ids := library(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    full = bpe.tokenize(df, PATH)
    assert full.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.doc_id), r.token_ids) for r in full.collect()) == sorted((str(i), library(t or "")) for i, t in rows)
    assert bpe.round_trip(docs([]), PATH).collect() == [] and bpe.tokenize(docs([]), PATH).collect() == []


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in bpe.round_trip(df, PATH).collect():
        ids = library(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
