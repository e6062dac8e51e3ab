"""Topics into macro groups: enrichment with a cache, grouping records, checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens import config as cfg
from reviewlens.functions import text as tx
from reviewlens.operators.clustering import kmeans_topics
from reviewlens.operators.dedup import keep_top
from reviewlens.operators.reshape import uncached

ENRICHMENT = T.StructType(
    [
        T.StructField("text_field", T.StringType()),
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("top_keywords", T.StringType()),
        T.StructField("resolved_keywords", T.StringType()),
        T.StructField("plain_description", T.StringType()),
        T.StructField("candidate_categories", T.ArrayType(T.StringType())),
        T.StructField("is_noise", T.BooleanType()),
        T.StructField("noise_reason", T.StringType()),
    ]
)
CACHE_KEYS = ["text_field", "topic_id", "top_keywords"]
TopicEnricher = Callable[[pd.DataFrame], pd.DataFrame]


def enrich(info: DataFrame, cache: DataFrame | None = None, factory: Callable[[], TopicEnricher] | None = None) -> DataFrame:
    """Enrichment rows for topics that are not in the cache yet.

    ``factory`` makes, once per task, a function from a frame of topics to a frame with the same rows in the same order
    and the columns resolved_keywords, plain_description, candidate_categories, is_noise, noise_reason. A batch that
    fails, or a row without a description, gets the fallback. Without a factory, keywords are only expanded.
    """
    work = info.filter(F.col("topic_id") != -1).select("text_field", "topic_id", "top_keywords", "doc_count")
    if cache is not None:
        work = uncached(work, cache, CACHE_KEYS)
    kw = F.coalesce("top_keywords", F.lit(""))
    blank = kw.isin("", cfg.UNLABELLED)
    if factory is None:
        answered = work.filter(~blank).select(
            *CACHE_KEYS,
            tx.expand_abbreviations(F.col("top_keywords")).alias("resolved_keywords"),
            F.lit(None).cast("string").alias("plain_description"),
            F.lit(None).cast("array<string>").alias("candidate_categories"),
            F.lit(None).cast("boolean").alias("is_noise"),
            F.lit(None).cast("string").alias("noise_reason"),
        )
    else:
        answered = work.filter(~blank).mapInPandas(_batches(factory), ENRICHMENT)
    filled = answered.select(
        *CACHE_KEYS,
        F.coalesce("resolved_keywords", "top_keywords").alias("resolved_keywords"),
        F.coalesce("plain_description", F.concat(F.lit("Keywords: "), "top_keywords")).alias("plain_description"),
        F.coalesce("candidate_categories", F.array(F.lit("other"))).alias("candidate_categories"),
        F.coalesce("is_noise", F.lit(False)).alias("is_noise"),
        "noise_reason",
    )
    empty = work.filter(blank).select(
        *CACHE_KEYS,
        kw.alias("resolved_keywords"),
        F.lit("Unlabelled topic").alias("plain_description"),
        F.array(F.lit("other")).alias("candidate_categories"),
        F.lit(True).alias("is_noise"),
        F.lit("No keywords available").alias("noise_reason"),
    )
    return filled.unionByName(empty)


def _batches(factory: Callable[[], TopicEnricher]):
    answers = ["resolved_keywords", "plain_description", "candidate_categories", "is_noise", "noise_reason"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enricher = factory()
        for pdf in frames:
            out = pdf[CACHE_KEYS].copy()
            try:
                got = enricher(pdf)
            except Exception:
                got = pd.DataFrame(index=pdf.index)
            for c in answers:
                out[c] = list(got[c]) if c in got else None
            yield out

    return run


def enrich_and_cache(info: DataFrame, path: str, factory: Callable[[], TopicEnricher] | None = None) -> DataFrame:
    """Enrich what the cache table lacks, append it, and return the rows for the topics asked for."""
    spark = info.sparkSession
    try:
        cache = spark.read.schema(ENRICHMENT).parquet(path)
    except AnalysisException as e:
        # Only a cache that does not exist yet counts as empty; any other trouble with the storage stops the job.
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = None
    enrich(info, cache, factory).write.mode("append").parquet(path)
    asked = spark.read.schema(ENRICHMENT).parquet(path).join(info.select(*CACHE_KEYS), CACHE_KEYS, "left_semi")
    # A batch that was appended twice, by a retried job, is one answer.
    return keep_top(asked, CACHE_KEYS, [F.col("plain_description").asc_nulls_last(), F.col("resolved_keywords").asc_nulls_last()])


# -- grouping records ----------------------------------------------------------------------

GROUPING_SCHEMA = """
text_field string,
macro_groups array<struct<group_key: string, group_label: string, group_description: string, topic_ids: array<int>, reasoning: string>>,
noise_topic_ids array<int>, ungrouped_topic_ids array<int>
"""


def grouping_claims(grouping: DataFrame) -> DataFrame:
    """Every (field, topic) a group or the noise list lays claim to, in the order the claims are made."""
    groups = grouping.select("text_field", F.posexplode("macro_groups").alias("ordinal", "g"))
    claims = groups.select(
        "text_field", F.explode("g.topic_ids").alias("topic_id"), F.col("g.group_key").alias("macro_group"),
        F.col("g.group_label").alias("group_label"), "ordinal",
    )
    noise = grouping.select(
        "text_field", F.explode("noise_topic_ids").alias("topic_id"), F.lit("noise").alias("macro_group"),
        F.lit("Noise / Filler").alias("group_label"), F.lit(2**31 - 1).alias("ordinal"),
    )
    return claims.unionByName(noise)


def grouping_mapping(grouping: DataFrame) -> DataFrame:
    """One group per topic: the last claim holds, and the noise list comes last."""
    return keep_top(grouping_claims(grouping), ["text_field", "topic_id"], [F.col("ordinal").desc()]).drop("ordinal")


def audit(claims: DataFrame, topics: DataFrame, min_groups: int = 10, max_groups: int = 20, large: int = 8, small: int = 2) -> DataFrame:
    """Rule breaches of a grouping, one row each (text_field, issue, subject, n).

    ``claims``: text_field, topic_id, macro_group. ``topics``: text_field, topic_id, the outlier topic left out.
    """
    real = topics.filter(F.col("topic_id") != -1)
    per_topic = claims.groupBy("text_field", "topic_id").agg(F.count(F.lit(1)).alias("n"))
    row = lambda issue, subject, n: ("text_field", F.lit(issue).alias("issue"), subject.alias("subject"), n.alias("n"))
    subject = F.col("topic_id").cast("string")
    twice = per_topic.filter("n > 1").select(*row("claimed_more_than_once", subject, F.col("n")))
    missing = real.join(per_topic, ["text_field", "topic_id"], "left_anti").select(
        *row("not_grouped", subject, F.lit(0).cast("bigint"))
    )
    sizes = claims.filter("macro_group <> 'noise'").groupBy("text_field", "macro_group").agg(F.countDistinct("topic_id").alias("n"))
    oversized = sizes.filter(F.col("n") > large).select(*row("oversized_group", F.col("macro_group"), F.col("n")))
    undersized = sizes.filter(F.col("n") <= small).select(*row("undersized_group", F.col("macro_group"), F.col("n")))
    groups = sizes.groupBy("text_field").agg(F.count(F.lit(1)).alias("n"))
    count = groups.filter(~F.col("n").between(min_groups, max_groups)).select(*row("group_count", F.lit("groups"), F.col("n")))
    return twice.unionByName(missing).unionByName(oversized).unionByName(undersized).unionByName(count)


def group_by_similarity(centroids: DataFrame, keywords: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """topic -> macro group from the data: bisecting k-means over topic vectors, named by the group's largest topic."""
    placed = kmeans_topics(centroids, k, "centroid", seed) if "topic_id" not in centroids.columns else (
        kmeans_topics(centroids.withColumnRenamed("topic_id", "__topic"), k, "centroid", seed)
        .withColumnRenamed("topic_id", "group_no")
        .withColumnRenamed("__topic", "topic_id")
    )
    named = placed.join(keywords, "topic_id", "left")
    lead = keep_top(named, ["group_no"], [F.col("n_vectors").desc(), F.col("topic_id")])
    labels = lead.select(
        "group_no", tx.label_of(F.coalesce("top_keywords", F.lit(cfg.UNLABELLED))).alias("group_label")
    )
    return placed.join(labels, "group_no").select(
        "topic_id", F.concat(F.lit("group_"), F.col("group_no").cast("string")).alias("macro_group"), "group_label"
    )
