"""The topic stage as one job: long reviews -> topics of every document and what each topic is, field by field.

Each field is a model of its own: texts are cleaned, encoded, clustered by density, merged down to a number of topics, and
documents left over go to their nearest topic. Counts, keywords and probabilities are taken after that, so they describe the
topics as they are handed out.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import clustering as cl
from reviewlens.operators import topics as tp
from reviewlens.operators import vectors as ve
from reviewlens.operators.lookup import join_small
from reviewlens.session import ensure_checkpoint_dir


class Topics(NamedTuple):
    """``documents``: the review columns of ``cfg.DOC_TOPIC_COLUMNS`` that are there, text_field, text, topic_id, probability
    and was_outlier. ``info``: text_field, topic_id, doc_count, top_keywords, label and is_product_cluster."""

    documents: DataFrame
    info: DataFrame


def field_topics(
    docs: DataFrame, key: str, min_topic_size: int = cfg.MIN_TOPIC_SIZE, max_topics: int = cfg.MAX_TOPICS, dim: int = 64, pivots: int = 256, stop: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(docs with topic_id, probability and was_outlier; topic info) of one field. ``docs``: key (a number), text, any others.

    Without any cluster all documents are outliers (-1), which have no probability.
    """
    stop = stop or tp.DEFAULT_STOP
    ensure_checkpoint_dir(docs.sparkSession)
    encoded = ve.embed(docs, ve.fit_embedding(docs, stop, dim=dim), stop).checkpoint()
    clusters = cl.density_clusters(encoded.select(key, "embedding"), key, pivots=pivots, min_cluster_size=min_topic_size)
    found = encoded.join(clusters.select(key, "topic_id"), key).checkpoint()
    centroids = ve.mean_vectors(found.filter("topic_id <> -1"), ["topic_id"])
    merged = ve.merge_topics(centroids, max_topics)
    placed = join_small(found, merged, ["topic_id"]).withColumn("topic_id", F.coalesce("merged_topic", F.lit(-1))).drop("merged_topic")
    moved = ve.reassign_outliers(placed).drop("topic_before").checkpoint()
    settled = ve.mean_vectors(moved.filter("topic_id <> -1"), ["topic_id"])
    scored = ve.nearest(moved, settled, "topic_id", k=max(1, max_topics), empty_ok=True)
    own = F.filter("near", lambda c: c["id"] == F.col("topic_id"))
    probability = round_half_up(F.exp(F.get(own, F.lit(0))["score"]) / F.col("exp_sum"), 4)
    documents = scored.withColumn("probability", probability).drop("near", "exp_sum", "embedding")
    words = moved.select("topic_id", "text")
    keywords = tp.clean_keywords(tp.top_terms(tp.ctfidf(words, ["topic_id"], stop), ["topic_id"]), ["topic_id"])
    return documents, tp.topic_info(words, keywords)


def run(reviews: DataFrame, fields: list[str] | None = None, settings: dict[str, dict] | None = None) -> Topics:
    """Topics of all fields. ``reviews``: review_id, text_field, text and review columns, one row per review and field.

    ``settings`` holds options of ``field_topics`` per field. Texts that are too short for a topic are left out, as are rows
    without an id; a field without usable texts has no topics. Fields are few, and each is a job over its own rows.
    """
    ensure_checkpoint_dir(reviews.sparkSession)
    fields, settings = fields or list(cfg.TEXT_FIELDS), settings or {}
    columns = [c for c in cfg.DOC_TOPIC_COLUMNS if c in reviews.columns]
    usable = tp.topic_texts(reviews.filter(F.col("text_field").isin(fields)).select(*columns, "text_field", "text"))
    # Numbered once and written, so a document keeps its number in every later pass.
    numbered = usable.filter(F.col("text").isNotNull() & F.col("review_id").isNotNull()).withColumn("__doc", F.monotonically_increasing_id()).checkpoint()
    documents, info = [], []
    for field in fields:
        mine = numbered.filter(F.col("text_field") == field)
        if mine.isEmpty():
            continue
        docs, about = field_topics(mine, "__doc", **settings.get(field, {}))
        documents.append(docs.select(*columns, "text_field", "text", "topic_id", "probability", "was_outlier"))
        info.append(about.select(F.lit(field).alias("text_field"), "topic_id", "doc_count", "top_keywords", "label", "is_product_cluster"))
    if not documents:
        raise ValueError("no field has a text long enough for topics")
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    return Topics(union(documents), union(info))
