"""Joins to topics and groups, reshaping, and the profiles of the long table."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import dedup, marts, quality, reshape
from reviewlens.operators.lookup import join_small
from reviewlens.plans import chain as ch
from reviewlens.plans import inputs as i
from reviewlens.plans.chain import pct
from reviewlens.plans.inputs import with_sql
from reviewlens.plans.registry import query

V_BEST = (
    "v_best",
    """
SELECT review_id, topic_id, probability FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY probability DESC NULLS LAST, topic_id) AS rn FROM v_docs)
WHERE rn = 1""",
)


@query("ddp_best", with_sql(i.V_DOCS, V_BEST, query="SELECT * FROM v_best"))
def ddp_best(spark, sf):
    return dedup.keep_best_topic(i.doc_topics(spark, sf))


def without_topic(spark, sf):
    return i.reviews_long(spark, sf).drop("topic_id")


@query(
    "jn_doc_topic",
    with_sql(
        i.V_LONG, i.V_DOCS, V_BEST,
        query="SELECT l.review_id, l.text_field, b.topic_id, b.probability FROM v_long l LEFT JOIN v_best b USING (review_id)",
    ),
)
def jn_doc_topic(spark, sf):
    joined = reshape.join_doc_topics(without_topic(spark, sf), i.doc_topics(spark, sf))
    return joined.select("review_id", "text_field", "topic_id", "probability")


# Info for all but topic 5, so the left join has misses.
INFO = (i.V_LONG, ch.V_INFO, ch.V_INFO_LABELLED)


def some_info(spark, sf):
    return ch.topic_info(spark, sf).filter("topic_id <> 5")


@query(
    "jn_topic_info",
    with_sql(
        *INFO,
        query="""
SELECT l.review_id, l.text_field, l.topic_id, t.label, t.top_keywords, t.is_product_cluster
FROM v_long l LEFT JOIN (SELECT * FROM v_infol WHERE topic_id <> 5) t ON l.text_field = t.text_field AND l.topic_id = t.topic_id""",
    ),
)
def jn_topic_info(spark, sf):
    joined = reshape.join_topic_info(i.reviews_long(spark, sf), some_info(spark, sf))
    return joined.select("review_id", "text_field", "topic_id", "label", "top_keywords", "is_product_cluster")


V_DIST = (
    "v_dist",
    """
SELECT d.*, t.label, t.top_keywords FROM (
  SELECT product_name, text_field, topic_id, CAST(count(*) AS BIGINT) AS doc_count FROM v_long GROUP BY ALL) d
JOIN v_infol t ON d.text_field = t.text_field AND d.topic_id = t.topic_id
WHERE d.topic_id <> -1 AND NOT t.is_product_cluster""",
)


@query(
    "jn_dist_info",
    with_sql(
        *INFO,
        query="""
SELECT c.product_name, c.text_field, c.topic_id, c.doc_count, t.label, t.top_keywords FROM (
  SELECT product_name, text_field, topic_id, CAST(count(*) AS BIGINT) AS doc_count FROM v_long GROUP BY ALL) c
LEFT JOIN v_infol t ON c.text_field = t.text_field AND c.topic_id = t.topic_id""",
    ),
)
def jn_dist_info(spark, sf):
    counts = marts.topic_counts(i.reviews_long(spark, sf), ["product_name", "text_field", "topic_id"])
    info = ch.topic_info(spark, sf).select("text_field", "topic_id", "label", "top_keywords")
    return join_small(counts, info, ["text_field", "topic_id"])


@query(
    "jn_valid_semi",
    with_sql(
        *INFO,
        query="""
SELECT review_id, text_field, topic_id FROM v_long l WHERE EXISTS (
  SELECT 1 FROM v_infol t WHERE t.text_field = l.text_field AND t.topic_id = l.topic_id AND t.topic_id <> -1 AND NOT t.is_product_cluster)""",
    ),
)
def jn_valid_semi(spark, sf):
    kept = marts.keep_valid(i.reviews_long(spark, sf), ch.topic_info(spark, sf))
    return kept.select("review_id", "text_field", "topic_id")


@query(
    "flt_valid_topics",
    with_sql(*INFO, query="SELECT text_field, topic_id, doc_count, label FROM v_infol WHERE topic_id <> -1 AND NOT is_product_cluster"),
)
def flt_valid_topics(spark, sf):
    return marts.valid_topics(ch.topic_info(spark, sf)).select("text_field", "topic_id", "doc_count", "label")


@query("agg_topic_dist", with_sql(*INFO, V_DIST, query="SELECT * FROM v_dist"))
def agg_topic_dist(spark, sf):
    return marts.topic_distribution(i.reviews_long(spark, sf), ch.topic_info(spark, sf))


@query(
    "win_dominant_topic",
    with_sql(
        *INFO, V_DIST,
        query="""
SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY product_name, text_field ORDER BY doc_count DESC, topic_id) AS rn FROM v_dist)
WHERE rn = 1""",
    ),
)
def win_dominant_topic(spark, sf):
    return marts.dominant_topic(marts.topic_distribution(i.reviews_long(spark, sf), ch.topic_info(spark, sf)))


@query(
    "win_topk_topics",
    with_sql(
        i.V_MAP,
        *INFO,
        query="""
SELECT 'overall' AS scope, text_field, topic_id, doc_count FROM (
  SELECT *, row_number() OVER (PARTITION BY text_field ORDER BY doc_count DESC, topic_id) AS rn FROM v_infol
  WHERE topic_id <> -1 AND NOT is_product_cluster) WHERE rn <= 15
UNION ALL
SELECT macro_group, text_field, topic_id, doc_count FROM (
  SELECT m.macro_group, t.text_field, t.topic_id, t.doc_count,
    row_number() OVER (PARTITION BY t.text_field, m.macro_group ORDER BY t.doc_count DESC, t.topic_id) AS rn
  FROM v_infol t JOIN v_map m ON t.topic_id = m.topic_id WHERE m.macro_group <> 'noise') WHERE rn <= 3
UNION ALL
SELECT 'unassigned', text_field, topic_id, doc_count FROM v_infol WHERE topic_id = 10""",
    ),
)
def win_topk_topics(spark, sf):
    info = ch.topic_info(spark, sf)
    grouped = reshape.with_noise_flag(reshape.apply_groups(info, i.topic_map(spark)))
    cols = ["text_field", "topic_id", "doc_count"]
    overall = marts.largest_topics(info).select(F.lit("overall").alias("scope"), *cols)
    per_group = marts.largest_topics_per_group(grouped).select(F.col("macro_group").alias("scope"), *cols)
    return overall.unionByName(per_group)


@query(
    "jn_group_apply",
    with_sql(*ch.CLASS, query="SELECT review_id, text_field, topic_id, macro_group, group_label FROM v_class"),
)
def jn_group_apply(spark, sf):
    grouped = reshape.apply_groups(i.reviews_long(spark, sf), i.topic_map(spark))
    return grouped.select("review_id", "text_field", "topic_id", "macro_group", "group_label")


@query("gr_noise_flag", with_sql(*ch.CLASS, query="SELECT review_id, topic_id, is_noise FROM v_class"))
def gr_noise_flag(spark, sf):
    return ch.classified(spark, sf).select("review_id", "topic_id", "is_noise")


@query(
    "jn_enrichment",
    with_sql(
        *INFO,
        query="""
SELECT text_field, topic_id, doc_count, CASE WHEN topic_id % 2 = 0 THEN concat('about ', top_keywords) ELSE '' END AS plain_description
FROM v_infol""",
    ),
)
def jn_enrichment(spark, sf):
    info = ch.topic_info(spark, sf)
    even = info.filter("topic_id % 2 = 0")
    enrichment = even.select("text_field", "topic_id", F.concat(F.lit("about "), "top_keywords").alias("plain_description"))
    return reshape.join_enrichment(info, enrichment).select("text_field", "topic_id", "doc_count", "plain_description")


@query(
    "jn_uncached_anti",
    with_sql(
        i.V_LONG,
        query="""
SELECT review_id, text_field FROM v_long WHERE NOT (text_field = 'likes' AND CAST(review_id AS BIGINT) % 2 = 0)""",
    ),
)
def jn_uncached_anti(spark, sf):
    work = i.reviews_long(spark, sf).select("review_id", "text_field")
    cache = work.filter("text_field = 'likes' AND CAST(review_id AS BIGINT) % 2 = 0")
    return reshape.uncached(work, cache, ["review_id", "text_field"])


# -- wide and long ------------------------------------------------------------------------

V_WIDE = (
    "v_wide",
    """
SELECT concat(product_name, '-', CAST(floor(CAST(review_id AS BIGINT) / 60) AS BIGINT)) AS review_id, product_name,
  max(CASE WHEN text_field = 'likes' THEN text END) AS likes, max(CASE WHEN text_field = 'dislikes' THEN text END) AS dislikes,
  max(CASE WHEN text_field = 'use_case' THEN text END) AS use_case, max(overall_rating) AS overall_rating,
  min(review_date) AS review_date
FROM v_long GROUP BY 1, 2""",
)


def wide_reviews(spark, sf):
    return spark.sql(V_WIDE[1].replace("FROM v_long", "FROM {v_long}"), v_long=i.reviews_long(spark, sf))


@query(
    "set_wide_to_long",
    with_sql(
        i.V_LONG, V_WIDE,
        query="\nUNION ALL\n".join(
            f"SELECT review_id, product_name, overall_rating, review_date, '{f}' AS text_field, sha256({f}) AS text_hash FROM v_wide "
            f"WHERE {f} IS NOT NULL" for f in ("likes", "dislikes", "use_case")
        ),
    ),
)
def set_wide_to_long(spark, sf):
    rows = reshape.wide_to_long(wide_reviews(spark, sf))
    return rows.withColumn("text_hash", F.sha2("text", 256)).drop("text")


WIDE_FIELDS = ["topic_id", "macro_group", "group_label", "is_noise"]
V_KEYED = (
    "v_keyed",
    "SELECT *, concat(product_name, '-', CAST(floor(CAST(review_id AS BIGINT) / 60) AS BIGINT)) AS wide_id FROM v_class",
)


@query(
    "set_long_to_wide",
    with_sql(
        *ch.CLASS, V_WIDE, V_KEYED,
        query="SELECT w.review_id, w.overall_rating, " + ", ".join(
            f"{f}.{c} AS {f}_{c}" for f in ("likes", "dislikes", "use_case") for c in WIDE_FIELDS
        ) + " FROM v_wide w " + " ".join(
            f"LEFT JOIN (SELECT * FROM v_keyed WHERE text_field = '{f}') {f} ON {f}.wide_id = w.review_id"
            for f in ("likes", "dislikes", "use_case")
        ),
    ),
)
def set_long_to_wide(spark, sf):
    wide = wide_reviews(spark, sf).select("review_id", "overall_rating")
    wide_id = F.concat("product_name", F.lit("-"), F.floor(F.col("review_id").cast("bigint") / 60).cast("string"))
    long_df = ch.classified(spark, sf).select(wide_id.alias("review_id"), "text_field", *WIDE_FIELDS)
    return reshape.long_to_wide(wide, long_df)


@query(
    "set_union_fields",
    with_sql(
        i.V_LONG,
        query="""
SELECT review_id, text_field, CASE WHEN text_field = 'likes' THEN topic_id END AS topic_id,
  CASE WHEN text_field = 'dislikes' THEN overall_rating END AS overall_rating,
  CASE WHEN text_field = 'use_case' THEN product_name END AS product_name FROM v_long""",
    ),
)
def set_union_fields(spark, sf):
    long_df = i.reviews_long(spark, sf)
    own = {"likes": "topic_id", "dislikes": "overall_rating", "use_case": "product_name"}
    return reshape.union_by_name(
        [long_df.filter(F.col("text_field") == f).select("review_id", "text_field", c) for f, c in own.items()]
    )


# -- profiles of the long table -----------------------------------------------------------

V_FULL = (
    "v_full",
    """
SELECT c.*, t.top_keywords FROM v_class c LEFT JOIN (SELECT * FROM v_infol WHERE topic_id <> 5) t
  ON c.text_field = t.text_field AND c.topic_id = t.topic_id""",
)
FULL = (*ch.CLASS, ch.V_INFO, ch.V_INFO_LABELLED, V_FULL)


def full_long(spark, sf):
    return reshape.join_topic_info(ch.classified(spark, sf), some_info(spark, sf))


@query(
    "agg_field_breakdown",
    with_sql(
        *FULL,
        query="""
SELECT text_field, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(macro_group) AS BIGINT) AS n_grouped,
  CAST(count(top_keywords) AS BIGINT) AS n_keywords, CAST(count(*) FILTER (is_noise) AS BIGINT) AS n_noise
FROM v_full GROUP BY text_field""",
    ),
)
def agg_field_breakdown(spark, sf):
    return quality.field_breakdown(full_long(spark, sf))


@query(
    "agg_coverage",
    with_sql(
        *ch.CLASS, i.V_DOCS, V_BEST,
        ("v_cov", "SELECT l.* EXCLUDE (topic_id, macro_group), b.topic_id, CASE WHEN b.topic_id IS NOT NULL THEN l.macro_group END "
                  "AS macro_group FROM v_class l LEFT JOIN v_best b USING (review_id)"),
        query=f"""
SELECT text_field, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(topic_id) AS BIGINT) AS n_topic,
  {pct("count(topic_id)", "count(*)")} AS pct_topic, CAST(count(macro_group) AS BIGINT) AS n_group,
  {pct("count(macro_group)", "count(*)")} AS pct_group, min(review_date) AS first_date, max(review_date) AS last_date,
  CAST(count(DISTINCT product_name) AS BIGINT) AS n_products, any_value(top_groups) AS top_groups
FROM v_cov LEFT JOIN (
  SELECT text_field, string_agg(concat(group_label, ': ', CAST(n AS VARCHAR)), ' | ' ORDER BY rn) AS top_groups FROM (
    SELECT *, row_number() OVER (PARTITION BY text_field ORDER BY n DESC, group_label) AS rn
    FROM (SELECT text_field, group_label, count(*) AS n FROM v_cov WHERE group_label IS NOT NULL GROUP BY ALL)) WHERE rn <= 8
  GROUP BY text_field) USING (text_field)
GROUP BY text_field""",
    ),
)
def agg_coverage(spark, sf):
    rows = reshape.join_doc_topics(ch.classified(spark, sf).drop("topic_id"), i.doc_topics(spark, sf))
    group = F.when(F.col("topic_id").isNotNull(), F.col("macro_group"))
    return quality.coverage_report(rows.withColumn("macro_group", group))


@query(
    "win_topk_pain",
    with_sql(
        *ch.CLASS,
        query="""
SELECT group_label, CAST(count(*) AS BIGINT) AS n_rows FROM v_class
WHERE text_field = 'dislikes' AND NOT is_noise GROUP BY group_label ORDER BY n_rows DESC, group_label LIMIT 10""",
    ),
)
def win_topk_pain(spark, sf):
    return marts.pain_points(ch.classified(spark, sf))
