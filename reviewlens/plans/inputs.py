"""Review-shaped inputs made from the given tables. The same SQL serves Spark and the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One row per review x field.
REVIEWS_LONG = """
SELECT CAST(d.doc_id AS STRING) AS review_id,
       d.source AS product_name,
       CASE CAST(floor(d.doc_id / 20) AS BIGINT) % 3 WHEN 0 THEN 'likes' WHEN 1 THEN 'dislikes' ELSE 'use_case' END
         AS text_field,
       d.text AS text,
       d.lang AS reviewer_company_size,
       CASE WHEN l.doc_id IS NULL THEN NULL
            ELSE CAST(1 + 3 * l.quality + (1 - l.toxic) AS DOUBLE) END AS overall_rating,
       (d.doc_id % 9 = 0) AS is_incentivized,
       DATE '2020-01-01' + CAST(d.doc_id % 1500 AS INT) AS review_date,
       CASE WHEN d.doc_id % 7 = 0 THEN concat('src', CAST((d.doc_id + 3) % 20 AS STRING)) END AS switched_from_product,
       CAST(CAST(floor(d.doc_id / 7) AS BIGINT) % 12 AS INT) - 1 AS topic_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

TOPIC_MAP = """
SELECT * FROM (VALUES
  (0,'core','Core & Accounting'),(1,'core','Core & Accounting'),(2,'reporting','Reporting, Dashboards'),
  (3,'reporting','Reporting, Dashboards'),(4,'support','Customer Support / Service'),
  (5,'support','Customer Support / Service'),(6,'setup','Setup | Cost'),(7,'setup','Setup | Cost'),
  (8,'usability','User Experience'),(9,'noise','Noise / Filler')) AS t(topic_id, macro_group, group_label)
"""
GROUP_LABELS = [
    "Core & Accounting", "Customer Support / Service", "Reporting, Dashboards", "Setup | Cost", "User Experience",
]

# At least one candidate topic per document; second rows make duplicates.
DOC_TOPICS = """
SELECT CAST(vec_id AS STRING) AS review_id, CAST(label AS INT) AS topic_id,
       CAST(vec_id % 97 AS DOUBLE) / 97 AS probability FROM embeddings
UNION ALL
SELECT CAST(vec_id AS STRING), CAST((label + 1) % 10 AS INT), CAST(vec_id % 89 AS DOUBLE) / 89
FROM embeddings WHERE vec_id % 4 = 0
"""

# Tokens of the invented prose that the built-in scorer counts.
LEXICON = {"the": 1, "and": 1, "with": 1, "of": -1, "is": -1, "that": -1}

# Conversations as reviews with several fields.
CONV_LONG = """
SELECT CAST(conv_id AS STRING) AS review_id,
       concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING), '-', role) AS row_id,
       CASE role WHEN 'user' THEN 'likes' WHEN 'assistant' THEN 'dislikes' ELSE 'use_case' END AS text_field,
       text, turn
FROM conversations
"""


TEXT_TABLES = ["documents", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that comes in fewer splits than there are cores; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, F.col(df.columns[0])) if df.rdd.getNumPartitions() < cores else df


def _sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    frames = {t: table(spark, sf_dir, t) for t in tables}
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **frames)


def reviews_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, REVIEWS_LONG, "documents", "labels")


def topic_map(spark: SparkSession) -> DataFrame:
    return spark.sql(TOPIC_MAP)


def doc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, DOC_TOPICS, "embeddings")


def conv_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CONV_LONG, "conversations")


def with_sql(*ctes: tuple[str, str], query: str, once: tuple[str, ...] = ()) -> str:
    """A SQL twin from named steps. Those in ``once`` are read by several others and computed once."""
    return "WITH " + ",\n".join(f"{name} AS {'MATERIALIZED ' if name in once else ''}({body})" for name, body in ctes) + "\n" + query


V_LONG = ("v_long", REVIEWS_LONG)
V_MAP = ("v_map", TOPIC_MAP)
V_DOCS = ("v_docs", DOC_TOPICS)
V_CONV = ("v_conv", CONV_LONG)


def r(expr: str, digits: int) -> str:
    """Half-up rounding in SQL, the same steps as ``round_half_up``."""
    scale = f"{10**digits}.0::DOUBLE"
    return f"(floor(({expr}) * {scale} + 0.5::DOUBLE) / {scale})"
