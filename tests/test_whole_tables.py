"""Queries that go over every document of their input."""

import duckdb
import pytest

from reviewlens.operators import topics as tp
from reviewlens.operators import vectors as ve
from reviewlens.plans import registry
from reviewlens.plans import vector_queries as vq

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["tm_keyphrase", "gr_by_similarity"])
def test_every_document_is_counted(spark, monkeypatch, name):
    """What reaches the term counts and the vectors is the whole table: 1,000 documents, of which 500 have a given vector."""
    seen = {}

    def counts(docs, keys, *rest, **more):
        seen["terms"] = {r.doc_id for r in docs.collect()}
        return ctfidf(docs, keys, *rest, **more)

    def vectors(docs, keys, *rest, **more):
        if "doc_id" in docs.columns:
            seen["vectors"] = {r.doc_id for r in docs.collect()}
        return means(docs, keys, *rest, **more)

    ctfidf, means = tp.ctfidf, ve.mean_vectors
    monkeypatch.setattr(tp, "ctfidf", counts)
    monkeypatch.setattr(ve, "mean_vectors", vectors)
    rows = registry.QUERIES[name](spark, SF).collect()
    every = {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall()}
    assert len(every) == 1000 and seen["terms"] == every and seen["vectors"] == every
    topics = {r.topic_id for r in (vq.long_topics if name == "tm_keyphrase" else vq.fine_topics)(spark, SF).collect()}
    assert {r.topic_id for r in rows} == topics
