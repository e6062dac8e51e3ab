"""Switching, incentives, segments, shares and topic overviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import marts, reshape
from reviewlens.plans import chain as ch
from reviewlens.plans import inputs as i
from reviewlens.plans.chain import pct
from reviewlens.plans.inputs import r, with_sql
from reviewlens.plans.registry import query

# Some reviews name two prior products.
V_SWITCH = (
    "v_switch",
    """
SELECT review_id, product_name, CASE WHEN CAST(review_id AS BIGINT) % 14 = 0
  THEN concat(switched_from_product, ' | other', CAST(CAST(review_id AS BIGINT) % 5 AS STRING)) ELSE switched_from_product END
  AS switched_from_product
FROM v_long""",
)


def switching(spark, sf):
    return spark.sql(V_SWITCH[1].replace("FROM v_long", "FROM {v_long}"), v_long=i.reviews_long(spark, sf))


@query(
    "agg_switch_rate",
    with_sql(
        i.V_LONG, V_SWITCH,
        query=f"""
SELECT product_name, CAST(count(*) AS BIGINT) AS n_reviews, CAST(count(switched_from_product) AS BIGINT) AS n_switched,
  {pct("count(switched_from_product)", "count(*)")} AS switch_pct
FROM v_switch GROUP BY ROLLUP (product_name)""",
    ),
)
def agg_switch_rate(spark, sf):
    return marts.switch_rate(switching(spark, sf))


@query(
    "agg_switch_origins",
    with_sql(
        i.V_LONG, V_SWITCH,
        query="""
SELECT origin, CAST(count(*) AS BIGINT) AS n_reviews
FROM (SELECT unnest(string_split(switched_from_product, ' | ')) AS origin FROM v_switch)
GROUP BY origin ORDER BY n_reviews DESC, origin LIMIT 10""",
    ),
)
def agg_switch_origins(spark, sf):
    return marts.switch_origins(switching(spark, sf))


@query(
    "agg_incentive_bias",
    with_sql(
        i.V_LONG,
        query=f"""
SELECT product_name, CAST(count(*) FILTER (is_incentivized) AS BIGINT) AS n_incentivized,
  CAST(count(*) FILTER (NOT is_incentivized) AS BIGINT) AS n_organic,
  {r(ch.exact_avg("paid", 2), 2)} AS avg_incentivized, {r(ch.exact_avg("organic", 2), 2)} AS avg_organic,
  {r(ch.exact_avg("paid", 2) + " - " + ch.exact_avg("organic", 2), 2)} AS bias
FROM (SELECT *, CASE WHEN is_incentivized THEN overall_rating END AS paid, CASE WHEN NOT is_incentivized THEN overall_rating END AS organic
  FROM v_long) GROUP BY product_name""",
    ),
)
def agg_incentive_bias(spark, sf):
    return marts.incentive_bias(i.reviews_long(spark, sf))


ORDERS = (
    "v_orders",
    """
SELECT o_orderkey AS review_id, o_orderdate, c_mktsegment AS company_size, o_orderpriority AS industry, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey""",
)


def orders(spark, sf):
    return i._sql(spark, sf, ORDERS[1], "orders", "customer")


@query(
    "agg_segment_trend",
    with_sql(
        ORDERS,
        query=f"""
SELECT 'month' AS grain, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS period, company_size AS segment,
  CAST(NULL AS VARCHAR) AS industry, 0 AS level, CAST(count(*) AS BIGINT) AS n_reviews,
  {r(ch.exact_avg("o_totalprice", 2), 2)} AS avg_value
FROM v_orders GROUP BY ALL
UNION ALL
SELECT 'cube', CAST(NULL AS VARCHAR), company_size, industry, CAST(grouping(company_size, industry) AS INTEGER),
  CAST(count(*) AS BIGINT), {r(ch.exact_avg("o_totalprice", 2), 2)}
FROM v_orders GROUP BY CUBE (company_size, industry)""",
    ),
)
def agg_segment_trend(spark, sf):
    rows, value = orders(spark, sf), F.col("o_totalprice")
    trend = marts.segment_trend(rows, "o_orderdate", "company_size", value).select(
        F.lit("month").alias("grain"), F.col("month").cast("string").alias("period"), "segment",
        F.lit(None).cast("string").alias("industry"), F.lit(0).alias("level"), "n_reviews", "avg_value",
    )
    cube = marts.segment_cube(rows, "company_size", "industry", value).select(
        F.lit("cube").alias("grain"), F.lit(None).cast("string").alias("period"), "segment", "industry", "level", "n_reviews", "avg_value"
    )
    return trend.unionByName(cube)


INFO = (i.V_LONG, ch.V_INFO, ch.V_INFO_LABELLED)


@query(
    "agg_topic_info",
    with_sql(*INFO, query="SELECT text_field, topic_id, doc_count, top_keywords, label, is_product_cluster FROM v_infol"),
)
def agg_topic_info(spark, sf):
    from reviewlens.operators.topics import topic_info

    docs = i.reviews_long(spark, sf).select("text_field", "topic_id")
    keywords = ch.topic_info(spark, sf).filter("topic_id <> -1 AND topic_id <> 7").select("text_field", "topic_id", "top_keywords")
    return topic_info(docs, keywords)


@query(
    "agg_topic_overview",
    with_sql(
        *INFO,
        query=f"""
SELECT text_field, CAST(count(*) FILTER (topic_id <> -1 AND NOT is_product_cluster) AS BIGINT) AS feature_topics,
  CAST(count(*) FILTER (topic_id <> -1 AND is_product_cluster) AS BIGINT) AS product_clusters,
  CAST(coalesce(sum(doc_count) FILTER (topic_id <> -1 AND is_product_cluster), 0) AS BIGINT) AS product_cluster_docs,
  CAST(coalesce(sum(doc_count) FILTER (topic_id = -1), 0) AS BIGINT) AS outlier_docs,
  {pct("coalesce(sum(doc_count) FILTER (topic_id = -1), 0)", "sum(doc_count)")} AS outlier_pct,
  CAST(sum(doc_count) AS BIGINT) AS total_docs
FROM v_infol GROUP BY text_field""",
    ),
)
def agg_topic_overview(spark, sf):
    return marts.topic_overview(ch.topic_info(spark, sf))


GROUPS_SQL = "SELECT DISTINCT macro_group, group_label FROM v_map WHERE macro_group <> 'noise' UNION ALL SELECT 'unused', 'Unused'"
SUMMARY_SQL = f"""
SELECT text_field, macro_group, group_label, group_description, n_topics, total_docs, top_keywords,
  {pct("total_docs", "sum(total_docs) OVER (PARTITION BY text_field)")} AS pct_docs
FROM (SELECT g.text_field, g.macro_group, g.group_label, concat('about ', g.macro_group) AS group_description, CAST(count(t.topic_id) AS BIGINT) AS n_topics,
    CAST(coalesce(sum(t.doc_count), 0) AS BIGINT) AS total_docs,
    coalesce(string_agg(substr(t.top_keywords, 1, 40), ' | ' ORDER BY t.rn) FILTER (t.rn <= 3), '') AS top_keywords
  FROM (SELECT * FROM ({GROUPS_SQL}), (SELECT DISTINCT text_field FROM v_infol)) g LEFT JOIN (
    SELECT t.text_field, m.macro_group, t.topic_id, t.doc_count, t.top_keywords,
      row_number() OVER (PARTITION BY t.text_field, m.macro_group ORDER BY t.doc_count DESC, t.topic_id) AS rn
    FROM v_infol t JOIN v_map m ON t.topic_id = m.topic_id) t
  ON g.macro_group = t.macro_group AND g.text_field = t.text_field GROUP BY g.text_field, g.macro_group, g.group_label)"""


def macro_inputs(spark, sf):
    groups = spark.sql(GROUPS_SQL.replace("FROM v_map", "FROM {v_map}"), v_map=i.topic_map(spark))
    groups = groups.withColumn("group_description", F.concat(F.lit("about "), "macro_group"))
    info = ch.topic_info(spark, sf)
    return groups, reshape.with_noise_flag(reshape.apply_groups(info, i.topic_map(spark))).drop("group_label")


@query("agg_macro_summary", with_sql(i.V_MAP, *INFO, query=f"SELECT * EXCLUDE pct_docs FROM ({SUMMARY_SQL})"))
def agg_macro_summary(spark, sf):
    return marts.macro_summary(*macro_inputs(spark, sf)).drop("pct_docs")


@query("agg_share", with_sql(i.V_MAP, *INFO, query=f"SELECT text_field, macro_group, total_docs, pct_docs FROM ({SUMMARY_SQL})"))
def agg_share(spark, sf):
    return marts.macro_summary(*macro_inputs(spark, sf)).select("text_field", "macro_group", "total_docs", "pct_docs")
