"""Term vectors against a numpy factorisation, planted synonyms, and odd texts."""

import random
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reviewlens.operators import term_vectors as tv
from reviewlens.session import scratch_path

T, C, W = 512, 32, 3


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def texts(n=60):
    rng = random.Random(5)
    words = [f"word{k}" for k in range(40)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def brute(spark, docs):
    counts = np.zeros((T, C))
    for r in docs.select(tv.word_hashes(F.col("text"), []).alias("h")).collect():
        t, c = tv._buckets(np.array(r.h, "int64"), T, C)
        for a in range(len(t)):
            for b in range(max(0, a - W), min(len(t), a + W + 1)):
                if a != b:
                    counts[t[a], c[b]] += 1
    return counts


def test_counts_and_vectors_equal_numpy(spark, monkeypatch):
    docs = frame(spark, texts() + [" ".join(f"word{k % 40}" for k in range(200))])
    counts = brute(spark, docs)
    for piece, part in ((4096, 10**6), (7, 20)):  # whole texts, and texts in many overlapping pieces
        monkeypatch.setattr(tv, "PIECE", piece)
        monkeypatch.setattr(tv, "SLICE", part)
        got = np.zeros((T, C))
        for r in tv.cooccurrence(docs, [], T, C, W).collect():
            got[r.term, r.context] = r.n
        assert (got == counts).all()
    n, rows, cols = counts.sum(), counts.sum(1), counts.sum(0)
    m = np.zeros_like(counts)
    at = counts > 0
    m[at] = np.maximum(np.log(counts[at] * n / np.outer(rows, cols)[at]), 0)
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    want = np.where(m.any(axis=1, keepdims=True), u[:, :8] * s[:8], 0.0)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-300)
    want *= (1e-3 / (1e-3 + rows / n))[:, None]
    model = tv.fit(docs, [], 8, T, C, W)
    assert np.allclose(model.matrix @ model.matrix.T, want @ want.T, atol=1e-6)
    path = scratch_path(spark, "term-vectors")
    model.save(spark, path)
    assert (tv.TermVectors.load(spark, path).matrix == model.matrix).all()


def test_synonyms_are_nearer_than_other_words(spark):
    rng = random.Random(7)
    road, food = [f"road{k}" for k in range(8)], [f"food{k}" for k in range(8)]
    docs = []
    for _ in range(400):
        word, around = rng.choice([("car", road), ("auto", road), ("banana", food)])
        docs.append(" ".join([*rng.sample(around, 3), word, *rng.sample(around, 3)]))
    model = tv.fit(frame(spark, docs), [], dim=16)
    rows = tv.embed(frame(spark, ["car", "auto", "banana", "road1 car", "unknownword", "", None]), model).orderBy("doc_id").collect()
    car, auto, banana, both, unknown, empty, null = (np.array(r.embedding) for r in rows)
    assert car @ auto > 0.8 > 0.3 > car @ banana
    assert abs(np.linalg.norm(both) - 1) < 1e-5 and not unknown.any() and not empty.any() and not null.any()


def test_tables_without_pairs(spark):
    for docs in (frame(spark, ["", None, "alone"]), spark.createDataFrame([], "doc_id long, text string")):
        model = tv.fit(docs, [], dim=4, terms=16, contexts=8)
        assert not model.matrix.any()
        assert all(list(r.embedding) == [0.0] * 4 for r in tv.embed(docs, model).collect())


def test_memory_of_a_task_does_not_follow_its_batches(spark, monkeypatch):
    """A task's memory beyond its table of counts and its batch stays the same, whether a batch holds few words or many."""
    caught = []
    docs = frame(spark, ["a"])
    monkeypatch.setattr(type(docs), "mapInPandas", lambda self, fn, schema: caught.append(fn) or self.selectExpr("1L AS cell", "1L AS n"))
    tv.cooccurrence(docs, [])
    rng, peaks = np.random.default_rng(1), []
    for rows in (100, 1000, 5000):
        batch = pd.DataFrame({"h": list(rng.integers(-(2**62), 2**62, (rows, 400)))})
        tracemalloc.start()
        found = sum(int(pdf["n"].sum()) for pdf in caught[0](iter([batch])))
        peaks.append(tracemalloc.get_traced_memory()[1] / 2**20)
        tracemalloc.stop()
        assert found == rows * 2 * (4 * 400 - 10)
    assert max(peaks) < 80, peaks
