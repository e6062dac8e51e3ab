"""Keyphrases against a plain computation: candidates ranked by vectors of the document encoder, over every document."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from harness import compare, connect
from pyspark.ml.feature import HashingTF

from reviewlens.operators import topics as tp
from reviewlens.operators import vectors as ve
from reviewlens.plans import registry
from reviewlens.plans import vector_queries as vq


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Texts of a few words each, null and empty ones among them. The words are anagrams of each other, so letters tell nothing."""
    rng = random.Random(11)
    words = sorted({"".join(rng.sample("nälsteri", 8)) for _ in range(40)})
    of_topic = {t: rng.sample(words, 24) for t in range(-1, 11)}
    rows = []
    for i in range(420):
        pool = of_topic[i // 7 % 12 - 1]
        rows.append((i, "src", "en", None if i % 50 == 0 else "" if i % 50 == 1 else " ".join(rng.choices(pool, k=rng.randint(1, 25)))))
    path = tmp_path_factory.mktemp("keyphrases")
    documents = pd.DataFrame(rows, columns=["doc_id", "source", "lang", "text"])  # noqa: F841
    labels = pd.DataFrame({"doc_id": [0], "quality": [1], "toxic": [0]})  # noqa: F841
    for name in ("documents", "labels"):
        duckdb.sql(f"COPY (SELECT * FROM {name}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return str(path)


def terms_of(text):
    words = re.findall(r"\w{2,}", (text or "").lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, candidates, dim):
    """{(topic, term): similarity} from (topic, text) pairs."""
    bucket = HashingTF(numFeatures=dim).indexOf
    x = np.zeros((len(docs), dim))
    for n, (_, text) in enumerate(docs):
        for term, k in Counter(terms_of(text)).items():
            x[n, bucket(term)] += k
    x *= np.log((len(docs) + 1) / ((x > 0).sum(axis=0) + 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    out = {}
    for topic, term in candidates:
        mine = [n for n, (t, _) in enumerate(docs) if t == topic]
        centroid, mean = x[mine].mean(axis=0), x[[n for n in mine if term in terms_of(docs[n][1])]].mean(axis=0)
        out[topic, term] = centroid @ mean / math.sqrt((centroid @ centroid) * (mean @ mean))
    return out


def test_ranks_follow_the_document_encoder(spark, folder):
    docs = vq.long_topics(spark, folder)
    candidates = [(r.topic_id, r.term) for r in vq.topic_keywords(docs).collect()]
    want = brute([(r.topic_id, r.text) for r in docs.orderBy("doc_id").collect()], candidates, vq.KEYPHRASE_DIM)
    best = defaultdict(list)
    for (topic, _), s in want.items():
        best[topic].append(s)
    got = registry.QUERIES["tm_keyphrase"](spark, folder).collect()
    assert len(got) == sum(min(10, len(s)) for s in best.values()) > 60
    assert all(abs(r.similarity - want[r.topic_id, r.term]) < 1e-4 for r in got)
    for topic, s in best.items():
        mine = sorted((r.term_rank, r.similarity) for r in got if r.topic_id == topic)
        assert np.allclose([x for _, x in mine], sorted(s, reverse=True)[:10], atol=1e-4)
    assert len({r.similarity for r in got}) > len(got) / 2


def test_twin_holds_with_null_and_empty_texts(spark, folder):
    assert compare(registry.QUERIES["tm_keyphrase"](spark, folder), connect(folder), registry.ORACLES["tm_keyphrase"]) is None


def test_sums_in_parts_and_given_vectors(spark, monkeypatch):
    """Sums that a task hands on early come to the same means; vectors of another encoder are taken as they are."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(12)]
    docs = [(n, n % 3, " ".join(rng.choice(words, 5)), [float(v) for v in rng.random(4)]) for n in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, topic_id int, text string, embedding array<float>").repartition(4)
    candidates = spark.createDataFrame([(t, w) for t in range(3) for w in words], "topic_id int, term string")
    monkeypatch.setattr(ve, "HELD_SUMS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {(r.topic_id, r.term): r.similarity for r in ve.keyphrases(df, candidates, [], n=12).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for topic in range(3):
        mine = [(t.split(), np.array(v)) for _, k, t, v in docs if k == topic]
        centroid = np.mean([v for _, v in mine], axis=0)
        for w in words:
            mean = np.mean([v for t, v in mine if w in t], axis=0)
            want[topic, w] = centroid @ mean / np.sqrt((centroid @ centroid) * (mean @ mean))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_no_documents(spark, folder):
    none = vq.long_topics(spark, folder).filter("false")
    candidates = spark.createDataFrame([], "topic_id int, term string")
    assert ve.keyphrases(ve.encode_with_candidates(none, candidates, tp.DEFAULT_STOP), candidates, tp.DEFAULT_STOP).collect() == []
