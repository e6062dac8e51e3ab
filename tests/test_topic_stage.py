"""The topic stage from long reviews to documents and topics: planted themes, refreshed counts, fields kept apart."""

import random

import pytest
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.operators import topic_stage

THEMES = {
    "invoice": "invoice billing ledger payment receipt balance".split(),
    "report": "report dashboard chart export metric widget".split(),
    "support": "agent ticket response helpdesk chat callback".split(),
}


def reviews(spark):
    rng = random.Random(3)
    rows = []
    for n in range(180):
        theme = list(THEMES)[n % 3]
        words = [rng.choice(THEMES[theme]) for _ in range(30)]
        rows.append((f"r{n}", "P", "likes" if n < 120 else "use_case", " ".join(words), theme, 4.0))
    rows += [("short", "P", "likes", "too short", "none", 1.0), (None, "P", "likes", " ".join(THEMES["report"] * 5), "none", 1.0), ("x", "P", "dislikes", None, "none", 1.0)]
    return spark.createDataFrame(rows, "review_id string, product_name string, text_field string, text string, theme string, overall_rating double")


@pytest.fixture(scope="module")
def stage(spark):
    source = reviews(spark)
    out = topic_stage.run(source, settings={"likes": {"pivots": 24, "max_topics": 5}, "use_case": {"pivots": 24, "max_topics": 2}})
    return source.select("review_id", "theme").filter("review_id IS NOT NULL"), out.documents.persist(), out.info.persist()


def test_every_usable_document_has_one_topic(stage):
    source, documents, _ = stage
    assert documents.columns == [c for c in cfg.DOC_TOPIC_COLUMNS if c in ("review_id", "product_name", "overall_rating")] + ["text_field", "text", "topic_id", "probability", "was_outlier"]
    rows = documents.collect()
    assert sorted(r.review_id for r in rows) == sorted(f"r{n}" for n in range(180))
    assert {r.text_field for r in rows} == {"likes", "use_case"}
    assert all(0 < r.probability <= 1 and r.topic_id >= 0 for r in rows)


def test_topics_are_the_themes(stage):
    source, documents, _ = stage
    pairs = documents.join(source, "review_id").filter("text_field = 'likes'").groupBy("topic_id", "theme").count().collect()
    assert len({r.topic_id for r in pairs}) >= 3 and sum(r["count"] for r in pairs) == 120
    best = {}
    for r in pairs:
        best[r.topic_id] = max(best.get(r.topic_id, 0), r["count"])
    assert sum(best.values()) >= 0.95 * 120


def test_counts_and_keywords_are_those_of_the_settled_topics(stage):
    _, documents, info = stage
    counted = {(r.text_field, r.topic_id): r["count"] for r in documents.groupBy("text_field", "topic_id").count().collect()}
    assert {(r.text_field, r.topic_id): r.doc_count for r in info.collect()} == counted
    assert sum(f == "use_case" for f, _ in counted) <= 2 and all(r.label for r in info.collect())


def test_no_usable_text(spark):
    with pytest.raises(ValueError):
        topic_stage.run(reviews(spark).filter(F.col("review_id") == "short"))
