"""Term counts in blocks against counting in a loop."""

import re
from collections import Counter

import pyarrow as pa
import pytest

from reviewlens.operators import term_blocks as tb
from reviewlens.operators import topics as tp

STOP = ["the", "of"]
TEXTS = [
    ("a", 1, "The cat of the house, the CAT sat"),
    ("a", 2, "cat cat cat; a b c"),
    ("b", 1, "Ünder_score 12 cat sat é the"),
    ("b", None, "cat sat on the cat sat"),
    (None, 3, "cat sat"),
    ("a", 1, None),
    ("a", 4, ""),
    ("a", 4, "of the of"),
    ("b", 2, "same words " * 50),
]


def expected():
    found = Counter()
    for field, topic, text in TEXTS:
        words = [w for w in re.findall(r"\w{2,}", (text or "").lower()) if w not in STOP]
        for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            found[field, topic, term] += 1
    return found


def table(spark):
    return spark.createDataFrame(TEXTS, "text_field string, topic_id int, text string").repartition(3)


@pytest.mark.parametrize("block, chunk", [(4 << 20, 8 << 20), (16, 8 << 20), (16, 1), (1, 20)])
def test_counts(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(tb, "BLOCK_BYTES", block)
    monkeypatch.setattr(tb, "CHUNK_BYTES", chunk)
    rows = tb.counts(table(spark), ["text_field", "topic_id"], STOP).collect()
    assert {(r.text_field, r.topic_id, r.term): r.n for r in rows} == expected()
    assert len(rows) == len(expected())


@pytest.mark.parametrize("block", [4 << 20, 16])
def test_frequent_terms_never_come_with_part_of_their_topics(spark, monkeypatch, block):
    monkeypatch.setattr(tb, "BLOCK_BYTES", block)
    rows = tb.frequent(table(spark), ["text_field", "topic_id"], STOP, 2).collect()
    whole, df, total = expected(), Counter(), Counter()
    for (field, _, term), n in whole.items():
        df[field, term] += 1
        total[field, term] += n
    found = {(r.text_field, r.topic_id, r.term): (r.n, r.doc_freq, r.term_total) for r in rows if r.term is not None}
    assert found == {(f, t, w): (n, df[f, w], total[f, w]) for (f, t, w), n in whole.items() if df[f, w] >= 2}
    assert {(r.text_field, r.topic_id) for r in rows if r.term is None} == {(f, t) for f, t, _ in whole}


def test_a_block_gets_one_row_per_task_and_not_one_per_term(spark):
    """The rows that are shuffled do not grow with the number of different terms."""
    texts = spark.range(2000).selectExpr("cast(id % 3 as int) topic_id", "concat('w', id, ' v', id * 7, ' u', id * 13) text").coalesce(2)
    assert tb.blocks_of(texts, ["topic_id"], STOP).count() <= 2
    assert tp.term_counts(texts, ["topic_id"], STOP).count() > 8000


def test_vocabulary_counts_equal_counts_joined_with_the_vocabulary(spark):
    keys = ["text_field", "topic_id"]
    counts = tp.term_counts(table(spark), keys, STOP)
    vocab = tp.vocabulary(counts, keys, 1, 0.7)
    want = counts.join(vocab, ["text_field", "term"]).select(*keys, "term", "n", "doc_freq", "term_total", "n_topics")
    got = tp.vocabulary_counts(table(spark), keys, STOP, 1, 0.7).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count()


def test_long_texts_are_cut_into_chunks():
    docs = pa.table({"topic_id": [1, 2], "lowered": ["aa bb aa", None]})
    (batch,) = tb._count(docs, ["topic_id"], pa.array(["bb"]), 0, 1)
    assert batch["term"].to_pylist() == [["aa", "aa aa"]] and batch["n"].to_pylist() == [[2, 1]]
