"""Raw items in the three source layouts, one per document, and the plain columns they were made from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.plans.inputs import _sql

# The values that go into the items. Both engines start from these.
RAW_COLUMNS = """
SELECT doc_id, source AS product_key, lang, text,
       CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN 'jupri' WHEN 1 THEN 'samstorm' ELSE 'focused_vanguard' END AS source_actor,
       CASE WHEN doc_id % 5 <> 0 THEN concat('r', CAST(doc_id AS STRING)) END AS native_id,
       concat(lang, ' ', source) AS cons,
       CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN concat(CAST(doc_id % 5 + 1 AS STRING), '.5/5') WHEN 1 THEN NULL
            WHEN 2 THEN concat('-', CAST(doc_id % 5 + 1 AS STRING)) ELSE '1.2.3' END AS score,
       concat('user', CAST(doc_id % 97 AS STRING)) AS reviewer,
       CASE WHEN doc_id % 10 <> 0 THEN concat('ind', CAST(doc_id % 13 AS STRING)) END AS industry,
       CASE CAST(doc_id % 4 AS INT)
            WHEN 0 THEN concat(CAST(DATE '2020-01-01' + CAST(doc_id % 1500 AS INT) AS STRING), 'T22:30:00.123-05:00')
            WHEN 1 THEN CAST(DATE '2020-01-01' + CAST(doc_id % 1500 AS INT) AS STRING)
            WHEN 2 THEN 'junk'
            ELSE concat(CAST(DATE '2020-01-01' + CAST(doc_id % 1500 AS INT) AS STRING), 'T01:02:03Z') END AS published,
       CASE CAST(doc_id % 7 AS INT) WHEN 0 THEN 'object' WHEN 1 THEN 'list' WHEN 2 THEN 'reason' ELSE 'none' END AS switch_kind,
       concat('src', CAST((doc_id + 3) % 20 AS STRING)) AS origin_a,
       concat('src', CAST((doc_id + 8) % 20 AS STRING)) AS origin_b,
       CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN 'g2gives' WHEN 1 THEN 'g2_incentivized' WHEN 2 THEN 'organic' END AS review_type,
       CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN 'G2' WHEN 1 THEN 'Capterra' WHEN 2 THEN 'TrustPilot' END AS record_platform
FROM documents
"""
V_RAW = ("v_raw", RAW_COLUMNS)

SCRAPED_AT = "2024-06-01T00:00:00+00:00"

ITEM_JSON = """
CASE source_actor
  WHEN 'jupri' THEN to_json(named_struct(
    'id', native_id,
    'answers', if(doc_id % 2 = 0, array(text, concat('  ', cons, '\t'), '', concat('use ', lang)), array(text, concat('  ', cons))),
    'score', score, 'name', reviewer, 'role', lang, 'segment', product_key, 'industry', industry,
    'location', parse_json(if(doc_id % 11 = 0, '"somewhere"',
        concat('{"country":"', lang, '","region":"R-', lang, '","primary":"', upper(lang), '"}'))),
    'date', named_struct('published', published, 'submitted', published, 'updated', published),
    'switched_from', parse_json(CASE switch_kind
        WHEN 'object' THEN concat('{"products":[{"id":"1","name":"', origin_a, '"},{"id":"2"},{"id":"3","name":"', origin_b,
                                  '"}],"reason":"why ', lang, '"}')
        WHEN 'list' THEN concat('[{"name":"', origin_a, '"}]')
        WHEN 'reason' THEN '{"reason":"only"}' ELSE 'null' END),
    'helpful', doc_id % 4, 'url', concat('http://x/', doc_id), 'source', named_struct('type', review_type),
    'title', concat('T ', doc_id), 'product_slug', product_key, 'product_id', doc_id % 100))
  WHEN 'samstorm' THEN to_json(named_struct(
    'reviewId', native_id, 'pros', text, 'cons', cons, 'overallRating', score, 'easeOfUse', doc_id % 5 + 0.5,
    'customerService', doc_id % 4, 'valueForMoney', 4.0, 'likelihood_to_recommend', doc_id % 11,
    'reviewerName', reviewer, 'reviewerTitle', lang, 'companySize', product_key, 'publishedDate', published,
    'sourceUrl', concat('http://y/', doc_id), 'featuresRating', doc_id % 3, 'reviewTitle', concat('T ', doc_id)))
  ELSE to_json(named_struct(
    'id', native_id, 'pros', text, 'cons', cons, 'body', concat('body ', lang), 'rating', score, 'author', reviewer,
    'authorTitle', lang, 'companySize', product_key, 'publishedAt', published, 'sourcePlatform', record_platform,
    'sourceUrl', concat('http://z/', doc_id)))
END
"""


def raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RAW_COLUMNS, "documents")


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source_actor, product_key, scraped_at and the item as JSON text."""
    return raw_columns(spark, sf_dir).select(
        "doc_id", "source_actor", "product_key", F.lit(SCRAPED_AT).alias("scraped_at"), F.expr(ITEM_JSON).alias("item_json")
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_text(spark, sf_dir).withColumn("item", F.try_parse_json("item_json")).drop("item_json")


def product_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per document source."""
    return (
        raw_columns(spark, sf_dir)
        .select("product_key")
        .distinct()
        .select(
            "product_key",
            F.concat(F.lit("P-"), "product_key").alias("product_id"),
            F.concat(F.lit("Product "), "product_key").alias("product_name"),
        )
    )
