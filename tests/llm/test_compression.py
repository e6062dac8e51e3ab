import zlib

import numpy as np
import pytest

from reviewlens.llm import compression as cx

LABELS = "doc_id long, quality int, toxic int"


def prose(n, words=80):
    return " ".join(f"wo{(n * 7 + k * k) % 53}rd" for k in range(words)) + "."


def junk(n, words=80):
    return " | ".join(f"J{(n * 5 + k) % 31}!!" for k in range(words))


@pytest.fixture
def corpus(docs, spark):
    rows = [(n, junk(n) if n % 4 == 0 else prose(n)) for n in range(600)] + [(900, None), (901, ""), (902, prose(3) * 3000), (3, prose(3)), (None, prose(3))]
    labels = [(n, int(n % 4 != 0), 0) for n in range(600) if n % 2 or n % 8 == 0] + [(5, None, 0), (10**6, 0, 0)]
    return docs(rows, score="mine", predicted="x", held_out=3), spark.createDataFrame(labels, LABELS), rows


def test_scores(corpus):
    df, labels, rows = corpus
    got = cx.classify(df, labels).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        key = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.held_out == (zlib.crc32(key) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    right = sum(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert right / len(held) > 0.95
    assert {r.score for r in got if r.doc_id in (900, 901)} == {next(r.score for r in got if r.doc_id == 901)}
    same = {r.score for r in got if text.get(r.doc_id) == prose(3) or r.doc_id is None}
    assert len(same) == 1


def test_held_out_labels_do_not_matter(corpus, spark):
    df, labels, _ = corpus
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = (sorted((str(r.doc_id), r.score) for r in cx.classify(df, x).collect()) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("keep", ["quality IS NULL", "quality = 1", "doc_id IN (1, 7)"])
def test_few_labels(corpus, keep):
    df, labels, rows = corpus
    got = cx.classify(df, labels.filter(keep)).collect()
    assert len(got) == len(rows) and len({r.score for r in got}) == 1 and got[0].predicted == 1


def test_one_text_for_each_label(docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], LABELS)
    got = {r.doc_id: r.score for r in cx.classify(docs([(1, prose(1)), (4, junk(4)), (6, prose(2))]), labels).collect()}
    assert got[1] > got[4]


def test_filter_keeps_columns(corpus):
    df, labels, rows = corpus
    kept = cx.keep_good(df, labels)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len([i for i in ids if i is not None and i < 600 and i % 4]) > 0.97 * 450 and not any(i is not None and i < 600 and i % 4 == 0 for i in ids)


def test_empty(docs, spark):
    none = spark.createDataFrame([], LABELS)
    assert cx.classify(docs([]), none).collect() == [] and cx.keep_good(docs([]), none).collect() == []


def test_chunks_cover_whole_texts():
    for n in (0, 1, cx.CHUNK - 1, cx.CHUNK, cx.CHUNK + 1, 3 * cx.CHUNK + 1500, 5 * cx.CHUNK + 10):
        t = bytes(k % 251 for k in range(n))
        assert b"".join(cx.chunks(t)) == t
    assert cx.shape(b"Abc DEF 12 | x!!") == b"Aa A 0 | a!!"


def test_logistic_matches_its_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=500) > 0).astype(float)
    w = np.array(cx.fit_logistic(x, y, ridge=1e-6))
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert np.abs(np.hstack([np.ones((500, 1)), x]).T @ (p - y)).max() < 1e-2


def test_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = cx.classify(docs, labels).filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    good, bad = ([r for r in rows if r.quality == y] for y in (1, 0))
    assert np.mean([r.predicted for r in good]) > 0.9 and np.mean([r.predicted for r in bad]) < 0.4
