"""The long table, its scored chain and marts over the given tables, and the same steps in SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import text as tx
from reviewlens.operators import reshape
from reviewlens.operators import sentiment as se
from reviewlens.plans import inputs as i
from reviewlens.plans.inputs import r

# -- topic info: keyed (text_field, topic_id) --------------------------------------------

INFO_SQL = f"""
SELECT text_field, topic_id, CAST(count(*) AS BIGINT) AS doc_count,
  CASE topic_id WHEN -1 THEN '{cfg.OUTLIER_KEYWORDS}' WHEN 7 THEN '{cfg.UNLABELLED}' WHEN 3 THEN 'oracle cloud, sap erp, quickbooks'
    WHEN 9 THEN 'navigate, easy navigate, navigation, search'
    ELSE concat('the reports, tion', CAST(topic_id AS STRING), ', and, ere, with') END AS top_keywords,
  (topic_id IN (3, 9)) AS is_product_cluster
FROM v_long GROUP BY text_field, topic_id
"""
V_INFO = ("v_info", INFO_SQL)


def topic_info(spark: SparkSession, sf: str) -> DataFrame:
    long_df = i.reviews_long(spark, sf)
    return spark.sql(INFO_SQL.replace("FROM v_long", "FROM {v_long}"), v_long=long_df).withColumn(
        "label", tx.label_of(F.col("top_keywords"))
    )


LABEL_SQL = (
    f"CASE WHEN top_keywords IN ('{cfg.OUTLIER_KEYWORDS}', '{cfg.UNLABELLED}') THEN top_keywords "
    "ELSE array_to_string(list_transform(string_split(top_keywords, ',')[1:3], lambda k: trim(k)), ' | ') END"
)
V_INFO_LABELLED = ("v_infol", f"SELECT *, {LABEL_SQL} AS label FROM v_info")

# -- classified long table -----------------------------------------------------------------

V_CLASS = (
    "v_class",
    """
SELECT l.*, CASE WHEN l.topic_id = -1 THEN 'outlier' ELSE coalesce(m.macro_group, 'unassigned') END AS macro_group,
  CASE WHEN l.topic_id = -1 THEN 'Outlier' ELSE coalesce(m.group_label, 'Unassigned') END AS group_label,
  (CASE WHEN l.topic_id = -1 THEN 'outlier' ELSE coalesce(m.macro_group, 'unassigned') END) IN ('noise', 'outlier') AS is_noise
FROM v_long l LEFT JOIN v_map m ON l.topic_id = m.topic_id""",
)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.with_noise_flag(reshape.apply_groups(i.reviews_long(spark, sf), i.topic_map(spark)))


V_SCOREABLE = (
    "v_scoreable",
    r"""
SELECT *, trim(regexp_replace(regexp_replace(lower(group_label), '[&,/\\|]+', ' ', 'g'), '\s+', ' ', 'g')) AS aspect_term
FROM v_class
WHERE text_field IN ('likes', 'dislikes') AND trim(text) <> '' AND NOT coalesce(is_noise, false)
  AND macro_group NOT IN ('noise', 'outlier', 'unassigned', '')""",
)

_PARTS = r"""list_filter(list_transform(string_split(regexp_replace(regexp_replace({t}, '^\s+|\s+$', '', 'g'),
  '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')),
  lambda s: length(s) >= 15)"""


def sentence_list(text: str) -> str:
    """SQL list of the sentences of a text, with the whole text as the fallback."""
    parts = _PARTS.format(t=text)
    whole = rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"
    return f"CASE WHEN len({parts}) > 0 THEN {parts} WHEN length({whole}) >= 15 THEN [{whole}] ELSE [] END"


def sentence_rows(source: str, columns: str) -> str:
    return f"""
SELECT {columns}, unnest(parts) AS sentence, CAST(unnest(range(len(parts))) AS INTEGER) AS sentence_idx,
  CAST(len(parts) AS INTEGER) AS n_sentences
FROM (SELECT *, {sentence_list("text")} AS parts FROM {source})"""


CHAIN_COLUMNS = (
    "review_id, product_name, text_field, reviewer_company_size, overall_rating, is_incentivized, review_date, "
    "switched_from_product, topic_id, macro_group, group_label, aspect_term"
)
V_SENT = ("v_sent", sentence_rows("v_scoreable", CHAIN_COLUMNS))


def scored_rows(source: str, lexicon: dict[str, int] = i.LEXICON) -> str:
    """SQL of the built-in scorer over a table with ``sentence``."""
    pos = ", ".join(f"'{t}'" for t, s in lexicon.items() if s > 0)
    neg = ", ".join(f"'{t}'" for t, s in lexicon.items() if s < 0)
    return rf"""
SELECT * EXCLUDE (p, n, u, words),
  CASE WHEN n >= greatest(p, u) AND n > u THEN CASE WHEN p > n THEN 'positive' ELSE 'negative' END
       WHEN u >= greatest(p, n) THEN 'neutral' ELSE 'positive' END AS sentiment_label,
  {r("p * 5.0::DOUBLE + u * 3.0::DOUBLE + n * 1.0::DOUBLE", 3)} AS absa_rating,
  {r("p", 4)} AS positive, {r("u", 4)} AS neutral, {r("n", 4)} AS negative
FROM (SELECT * EXCLUDE (ep, en, eu), ep / (ep + eu + en) AS p, en / (ep + eu + en) AS n, eu / (ep + eu + en) AS u FROM (
  SELECT * EXCLUDE (lp, ln, m), exp((lp - m)::DOUBLE) AS ep, exp((ln - m)::DOUBLE) AS en, exp((0 - m)::DOUBLE) AS eu
  FROM (SELECT *, greatest(lp, ln, 0) AS m FROM (
    SELECT *, len(list_filter(words, lambda w: w IN ({pos}))) AS lp, len(list_filter(words, lambda w: w IN ({neg}))) AS ln
    FROM (SELECT *, regexp_extract_all(lower(sentence), '[\p{{L}}\p{{N}}_]{{2,}}') AS words FROM {source})))))"""


V_SCORED = ("v_scored", scored_rows("v_sent"))


def exact_avg(col: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return (
        f"(sum(CAST(floor({col} * {scale} + 0.5::DOUBLE) AS BIGINT))::DOUBLE / (count({col})::DOUBLE * {scale}))"
    )


def pct(part: str, whole: str, digits: int = 1) -> str:
    return r(f"({part})::DOUBLE * 100.0::DOUBLE / nullif(({whole})::DOUBLE, 0)", digits)


REVIEW_KEYS = (
    "review_id, product_name, text_field, macro_group, group_label, aspect_term, reviewer_company_size, overall_rating, "
    "is_incentivized, review_date, switched_from_product"
)


def review_rows(source: str, keys: str = REVIEW_KEYS) -> str:
    return f"""
SELECT * EXCLUDE (n_neg, n_neu, n_pos),
  CASE WHEN n_neg >= n_neu AND n_neg >= n_pos THEN 'negative' WHEN n_neu >= n_pos THEN 'neutral' ELSE 'positive' END
    AS sentiment_label
FROM (SELECT {keys}, {r(exact_avg("absa_rating", 3), 3)} AS absa_rating, min(absa_rating) AS absa_rating_min,
    max(absa_rating) AS absa_rating_max, {exact_avg("positive", 4)} AS positive_avg, {exact_avg("neutral", 4)} AS neutral_avg,
    {exact_avg("negative", 4)} AS negative_avg, CAST(count(*) AS BIGINT) AS n_sentences,
    count(*) FILTER (sentiment_label = 'negative') AS n_neg, count(*) FILTER (sentiment_label = 'neutral') AS n_neu,
    count(*) FILTER (sentiment_label = 'positive') AS n_pos
  FROM {source} GROUP BY {keys})"""


V_REVIEW = ("v_review", review_rows("v_scored"))
V_ASPECT = (
    "v_aspect",
    f"""
SELECT product_name, macro_group, group_label, aspect_term, text_field, {r(exact_avg("absa_rating", 3), 2)} AS avg_rating,
  CAST(count(review_id) AS BIGINT) AS n_reviews, CAST(sum(n_sentences) AS BIGINT) AS n_sentences,
  {pct("count(*) FILTER (sentiment_label = 'positive')", "count(*)")} AS pct_positive,
  {pct("count(*) FILTER (sentiment_label = 'neutral')", "count(*)")} AS pct_neutral,
  {pct("count(*) FILTER (sentiment_label = 'negative')", "count(*)")} AS pct_negative,
  {r(exact_avg("overall_rating", 2), 2)} AS avg_overall_rating,
  {pct("sum(CAST(is_incentivized AS INT))", "count(is_incentivized)")} AS pct_incentivized
FROM v_review GROUP BY ALL""",
)
V_NET = (
    "v_net",
    f"""
SELECT *, CAST((likes_rating IS NOT NULL) AS INT) + CAST((dislikes_rating IS NOT NULL) AS INT) AS n_sides,
  {r("(coalesce(likes_rating, 3.0::DOUBLE) + coalesce(dislikes_rating, 3.0::DOUBLE)) / 2.0::DOUBLE", 2)} AS net_rating,
  {r("coalesce(likes_rating, 3.0::DOUBLE) - (6.0::DOUBLE - coalesce(dislikes_rating, 3.0::DOUBLE))", 2)} AS sentiment_gap
FROM (SELECT coalesce(l.product_name, d.product_name) AS product_name, coalesce(l.macro_group, d.macro_group) AS macro_group,
    coalesce(l.group_label, d.group_label) AS group_label, l.avg_rating AS likes_rating, l.n_reviews AS likes_n_reviews,
    l.pct_positive AS likes_pct_positive, l.pct_negative AS likes_pct_negative, l.avg_overall_rating,
    d.avg_rating AS dislikes_rating, d.n_reviews AS dislikes_n_reviews, d.pct_positive AS dislikes_pct_positive,
    d.pct_negative AS dislikes_pct_negative
  FROM (SELECT * FROM v_aspect WHERE text_field = 'likes') l
  FULL OUTER JOIN (SELECT * FROM v_aspect WHERE text_field = 'dislikes') d
    ON l.product_name = d.product_name AND l.macro_group = d.macro_group)""",
)

CLASS = (i.V_LONG, i.V_MAP, V_CLASS)
SENT = (*CLASS, V_SCOREABLE, V_SENT)
SCORED = (*SENT, V_SCORED)
REVIEW = (*SCORED, V_REVIEW)
ASPECT = (*REVIEW, V_ASPECT)
NET = (*ASPECT, V_NET)

lexicon_score = partial(se.score_with_lexicon, lexicon=i.LEXICON)


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return se.split_sentences(se.scoreable(classified(spark, sf)))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon_score(sentences(spark, sf))


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return se.to_reviews(scored(spark, sf))


def aspects(spark: SparkSession, sf: str) -> DataFrame:
    return se.to_product_aspect(reviews(spark, sf))


def net(spark: SparkSession, sf: str) -> DataFrame:
    return se.net_scores(aspects(spark, sf))
