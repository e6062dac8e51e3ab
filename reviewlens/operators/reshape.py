"""Wide to long and back, joins to topics, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.operators.conform import reorder
from reviewlens.operators.dedup import keep_best_topic
from reviewlens.operators.lookup import join_small


def wide_to_long(reviews: DataFrame, fields: list[str] = cfg.TEXT_FIELDS) -> DataFrame:
    """One row per review and non-null field, in one pass."""
    ids = [c for c in cfg.CONTEXT_COLUMNS if c in reviews.columns]
    present = [f for f in fields if f in reviews.columns]
    return reviews.unpivot(ids, present, "text_field", "text").filter(F.col("text").isNotNull())


def join_doc_topics(long_df: DataFrame, doc_topics: DataFrame) -> DataFrame:
    """Add topic and probability per (review, field); each document keeps its best topic row."""
    keys = [k for k in ("review_id", "text_field") if k in doc_topics.columns]
    best = keep_best_topic(doc_topics.select(*keys, "topic_id", "probability"), keys)
    return long_df.join(best, keys, "left")


def join_topic_info(df: DataFrame, info: DataFrame) -> DataFrame:
    """Add what is known of each topic, apart from its document count."""
    keys = [k for k in ("text_field", "topic_id") if k in info.columns]
    return join_small(df, info.drop("doc_count"), keys)


def text_classified(reviews: DataFrame, doc_topics: DataFrame, info: DataFrame) -> DataFrame:
    """The long table: review x field with its topic and group columns."""
    long_df = wide_to_long(reviews)
    return reorder(join_topic_info(join_doc_topics(long_df, doc_topics), info), cfg.LONG_COLUMNS)


def apply_groups(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """topic -> macro group and label: -1 is the outlier group, a topic without a group is unassigned."""
    keys = [k for k in ("text_field", "topic_id") if k in mapping.columns]
    named = mapping.select(*keys, F.col("macro_group").alias("__group"), F.col("group_label").alias("__label"))
    joined = join_small(df.drop("macro_group", "group_label"), named, keys)
    outlier = F.col("topic_id") == -1
    return joined.withColumns(
        {
            "macro_group": F.when(outlier, "outlier").otherwise(F.coalesce(F.col("__group"), F.lit("unassigned"))),
            "group_label": F.when(outlier, "Outlier").otherwise(F.coalesce(F.col("__label"), F.lit("Unassigned"))),
        }
    ).drop("__group", "__label")


def with_noise_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_noise", F.col("macro_group").isin("noise", "outlier"))


def join_enrichment(info: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Plain description per topic, empty where there is none."""
    keys = [k for k in ("text_field", "topic_id") if k in enrichment.columns]
    slim = enrichment.select(*keys, F.col("plain_description").alias("__description"))
    return (
        info.drop("plain_description")
        .join(slim, keys, "left")
        .withColumn("plain_description", F.coalesce(F.col("__description"), F.lit("")))
        .drop("__description")
    )


def uncached(work: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key is not in the cache table yet."""
    return work.join(cache.select(*keys), keys, "left_anti")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing in one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


FIELD_COLUMNS = [
    "topic_id", "probability", "macro_group", "group_label", "plain_description", "is_noise", "is_product_cluster",
]


def long_to_wide(meta: DataFrame, long_df: DataFrame, fields: list[str] = cfg.TEXT_FIELDS) -> DataFrame:
    """One row per review with ``{field}_{column}`` for every field; (review, field) is unique in the long table."""
    cols = [c for c in FIELD_COLUMNS if c in long_df.columns]
    aggs = [
        F.max(F.when(F.col("text_field") == f, F.col(c))).alias(f"{f}_{c}") for f in fields for c in cols
    ]
    return meta.join(long_df.groupBy("review_id").agg(*aggs), "review_id", "left")
