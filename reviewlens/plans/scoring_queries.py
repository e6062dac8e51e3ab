"""Aspect sentiment: filters, sentences, scorers, roll-ups, net scores and the heatmap."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from reviewlens.functions import scoring as sc
from reviewlens.functions import text as tx
from reviewlens.operators import marts
from reviewlens.operators import sentiment as se
from reviewlens.plans import chain as ch
from reviewlens.plans import inputs as i
from reviewlens.plans.chain import pct
from reviewlens.plans.inputs import r, with_sql
from reviewlens.plans.registry import query


@query("flt_field", with_sql(i.V_LONG, query="SELECT review_id, text_field FROM v_long WHERE text_field IN ('likes', 'dislikes')"))
def flt_field(spark, sf):
    return i.reviews_long(spark, sf).filter(F.col("text_field").isin("likes", "dislikes")).select("review_id", "text_field")


@query(
    "flt_scoreable",
    with_sql(*ch.CLASS, ch.V_SCOREABLE, query="SELECT review_id, text_field, macro_group, group_label, aspect_term FROM v_scoreable"),
)
def flt_scoreable(spark, sf):
    return se.scoreable(ch.classified(spark, sf)).select("review_id", "text_field", "macro_group", "group_label", "aspect_term")


@query(
    "txt_sentences",
    with_sql(
        i.V_LONG,
        ("v_rows", ch.sentence_rows("v_long", "review_id, text_field")),
        query="SELECT review_id, text_field, sentence_idx, n_sentences, sha256(sentence) AS sentence_hash FROM v_rows",
    ),
)
def txt_sentences(spark, sf):
    rows = se.split_sentences(i.reviews_long(spark, sf))
    return rows.select("review_id", "text_field", "sentence_idx", "n_sentences", F.sha2("sentence", 256).alias("sentence_hash"))


@query(
    "txt_whole_text",
    with_sql(
        *ch.CLASS, ch.V_SCOREABLE,
        query="SELECT review_id, aspect_term, sha256(text) AS sentence_hash, 0 AS sentence_idx, 1 AS n_sentences FROM v_scoreable",
    ),
)
def txt_whole_text(spark, sf):
    rows = se.whole_texts(se.scoreable(ch.classified(spark, sf)))
    return rows.select("review_id", "aspect_term", F.sha2("sentence", 256).alias("sentence_hash"), "sentence_idx", "n_sentences")


@query("txt_aspect_term", with_sql(*ch.CLASS, ch.V_SCOREABLE, query=r"""
SELECT group_label, trim(regexp_replace(regexp_replace(lower(group_label), '[&,/\\|]+', ' ', 'g'), '\s+', ' ', 'g')) AS aspect_term,
  CAST(count(*) AS BIGINT) AS n_rows
FROM v_class GROUP BY ALL"""))  # fmt: skip
def txt_aspect_term(spark, sf):
    return (
        ch.classified(spark, sf)
        .select("group_label", tx.aspect_term(F.col("group_label")).alias("aspect_term"))
        .groupBy("group_label", "aspect_term")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


RELEVANCE = 0.3


@query(
    "flt_relevance",
    with_sql(
        i.V_LONG,
        ch.V_INFO,
        ("v_rows", ch.sentence_rows("v_long", "review_id, text_field, topic_id")),
        ("v_kw", "SELECT s.*, list_filter(list_transform(string_split(lower(top_keywords), ','), lambda k: trim(k)), "
                 "lambda k: k <> '') AS kws FROM v_rows s LEFT JOIN v_info USING (text_field, topic_id)"),
        query=f"""
SELECT review_id, text_field, sentence_idx, n_sentences FROM v_kw
WHERE coalesce(len(list_filter(kws, lambda k: contains(lower(sentence), k)))::DOUBLE / len(kws)::DOUBLE, 1) >= {RELEVANCE}""",
    ),
)
def flt_relevance(spark, sf):
    from reviewlens.operators.reshape import join_topic_info

    rows = se.split_sentences(join_topic_info(i.reviews_long(spark, sf), ch.topic_info(spark, sf)))
    return se.relevant_sentences(rows, RELEVANCE).select("review_id", "text_field", "sentence_idx", "n_sentences")


@query(
    "sc_pair",
    with_sql(*ch.SENT, query="SELECT review_id, sentence_idx, sha256(concat(sentence, ' [SEP] ', aspect_term)) AS pair_hash FROM v_sent"),
)
def sc_pair(spark, sf):
    pair = sc.pair(F.col("sentence"), F.col("aspect_term"))
    return ch.sentences(spark, sf).select("review_id", "sentence_idx", F.sha2(pair, 256).alias("pair_hash"))


SCORE_COLUMNS = ["review_id", "text_field", "sentence_idx", "positive", "neutral", "negative", "sentiment_label", "absa_rating"]
SCORES_SQL = f"SELECT {', '.join(SCORE_COLUMNS)} FROM v_scored"


@query("sc_lexicon", with_sql(*ch.SCORED, query=SCORES_SQL))
def sc_lexicon(spark, sf):
    return ch.scored(spark, sf).select(*SCORE_COLUMNS)


def lexicon_model(lexicon: dict[str, int]):
    """A plug-in scorer with the built-in scorer's arithmetic, to exercise the batch contract."""

    def factory():
        import numpy as np
        import regex

        word = regex.compile(tx.WORD)

        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            tokens = [word.findall(s.lower()) for s in pdf["sentence"]]
            count = lambda sign: np.array([sum(lexicon.get(t) == sign for t in ts) for ts in tokens], "float64")
            n_pos, n_neg = count(1), count(-1)
            most = np.maximum(np.maximum(n_pos, n_neg), 0)
            pos, neg, neu = np.exp(n_pos - most), np.exp(n_neg - most), np.exp(-most)
            total = pos + neu + neg
            return pd.DataFrame({"positive": pos / total, "neutral": neu / total, "negative": neg / total})

        return score

    return factory


@query("sc_infer", with_sql(*ch.SCORED, query=SCORES_SQL))
def sc_infer(spark, sf):
    return se.infer(ch.sentences(spark, sf), lexicon_model(i.LEXICON)).select(*SCORE_COLUMNS)


@query(
    "sc_rating",
    f"""
SELECT event_id, p AS positive, u AS neutral, n AS negative,
  {r("p * 5.0::DOUBLE + u * 3.0::DOUBLE + n * 1.0::DOUBLE", 3)} AS absa_rating,
  CASE WHEN u >= p AND u >= n THEN 'neutral' WHEN n >= p THEN 'negative' ELSE 'positive' END AS sentiment_label
FROM (SELECT event_id, CAST(event_id % 7 AS DOUBLE) / 12 AS p, CAST(event_id % 6 AS DOUBLE) / 12 AS n,
      CAST(12 - event_id % 7 - event_id % 6 AS DOUBLE) / 12 AS u FROM events)""",
)
def sc_rating(spark, sf):
    part = lambda e: F.expr(f"CAST({e} AS DOUBLE) / 12D")
    p = {
        "positive": part("event_id % 7"),
        "neutral": part("12 - event_id % 7 - event_id % 6"),
        "negative": part("event_id % 6"),
    }
    return i.table(spark, sf, "events").select(
        "event_id", *[v.alias(k) for k, v in p.items()], sc.rating(p).alias("absa_rating"), sc.top_label(p).alias("sentiment_label")
    )


@query("agg_review", with_sql(*ch.REVIEW, query="SELECT * FROM v_review"))
def agg_review(spark, sf):
    return ch.reviews(spark, sf)


@query("agg_product_aspect", with_sql(*ch.ASPECT, query="SELECT * FROM v_aspect"))
def agg_product_aspect(spark, sf):
    return ch.aspects(spark, sf)


@query("jn_likes_dislikes", with_sql(*ch.NET, query="""
SELECT product_name, macro_group, likes_rating, likes_n_reviews, dislikes_rating, dislikes_n_reviews FROM v_net"""))  # fmt: skip
def jn_likes_dislikes(spark, sf):
    return se.likes_vs_dislikes(ch.aspects(spark, sf)).select(
        "product_name", "macro_group", "likes_rating", "likes_n_reviews", "dislikes_rating", "dislikes_n_reviews"
    )


@query("agg_net", with_sql(*ch.NET, query="SELECT * FROM v_net"))
def agg_net(spark, sf):
    return ch.net(spark, sf)


@query("win_sort_net", with_sql(*ch.NET, query="""
SELECT product_name, macro_group, net_rating FROM v_net ORDER BY product_name, net_rating DESC, macro_group"""))  # fmt: skip
def win_sort_net(spark, sf):
    return se.sort_net(ch.net(spark, sf)).select("product_name", "macro_group", "net_rating")


_NAMED = ", ".join(f"'{g}'" for g in i.GROUP_LABELS)
HEATMAP_SQL = "SELECT product_name, " + ", ".join(
    f"""{r(f"sum(CAST(floor(net_rating * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)) FILTER ({rows})::DOUBLE "
           f"/ (count(net_rating) FILTER ({rows})::DOUBLE * 100.0::DOUBLE)", 2)} AS "{g}" """
    for g, rows in [*[(g, f"group_label = '{g}'") for g in i.GROUP_LABELS], ("other aspects", f"group_label NOT IN ({_NAMED})")]
) + " FROM v_net WHERE group_label IS NOT NULL GROUP BY product_name"


@query("win_pivot_heatmap", with_sql(*ch.NET, query=HEATMAP_SQL))
def win_pivot_heatmap(spark, sf):
    return se.heatmap(ch.net(spark, sf), i.GROUP_LABELS)


@query(
    "agg_sentiment_mix",
    with_sql(
        *ch.SCORED,
        query=f"""
SELECT sentiment_label, CAST(count(*) AS BIGINT) AS n_sentences, {pct("count(*)", "(SELECT count(*) FROM v_scored)")} AS pct,
  {r("(SELECT sum(CAST(floor(absa_rating * 1000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT))::DOUBLE / (count(*) * 1000.0::DOUBLE) FROM v_scored)", 2)}
    AS avg_rating
FROM v_scored GROUP BY sentiment_label""",
    ),
)
def agg_sentiment_mix(spark, sf):
    return marts.sentiment_mix(ch.scored(spark, sf))


@query(
    "agg_sent_per_review",
    with_sql(
        i.V_CONV,
        ("v_rows", ch.sentence_rows("v_conv", "review_id, text_field")),
        query=f"""
SELECT CAST(count(*) AS BIGINT) AS n_sentences, CAST(count(DISTINCT review_id) AS BIGINT) AS n_reviews,
  {r("count(*)::DOUBLE / greatest(count(DISTINCT review_id), 1)", 1)} AS avg_per_review
FROM v_rows""",
    ),
)
def agg_sent_per_review(spark, sf):
    return marts.sentences_per_review(se.split_sentences(i.conv_long(spark, sf)))


@query(
    "agg_rankings",
    with_sql(
        *ch.NET,
        query=f"""
SELECT 'aspect' AS dimension, group_label AS name, {r(ch.exact_avg("net_rating", 2), 2)} AS avg_net_rating
FROM v_net WHERE group_label IS NOT NULL GROUP BY group_label
UNION ALL
SELECT 'product', product_name, {r(ch.exact_avg("net_rating", 2), 2)} FROM v_net GROUP BY product_name""",
    ),
)
def agg_rankings(spark, sf):
    return marts.rankings(ch.net(spark, sf))


@query(
    "agg_aspect_spread",
    with_sql(
        *ch.ASPECT,
        query=f"""
SELECT aspect_term, text_field, CAST(count(*) AS BIGINT) AS n_products, min(avg_rating) AS min_rating, max(avg_rating) AS max_rating,
  {r("max(avg_rating) - min(avg_rating)", 2)} AS rating_range,
  first(product_name ORDER BY avg_rating, product_name) AS weakest_product,
  first(product_name ORDER BY avg_rating DESC, product_name) AS strongest_product
FROM v_aspect GROUP BY aspect_term, text_field""",
    ),
)
def agg_aspect_spread(spark, sf):
    return marts.aspect_spread(ch.aspects(spark, sf))


@query(
    "win_best_per_aspect",
    with_sql(
        *ch.NET,
        ("v_vendors", "SELECT source AS product_name, concat('vendor', CAST(min(doc_id) % 4 AS VARCHAR)) AS vendor FROM documents GROUP BY 1"),
        query=f"""
SELECT w.group_label, w.product_name, w.net_rating, v.vendor_best, {r("w.net_rating - v.vendor_best", 2)} AS vendor_gap
FROM (SELECT *, rank() OVER (PARTITION BY group_label ORDER BY net_rating DESC) AS rk FROM v_net) w
LEFT JOIN (SELECT group_label, max(net_rating) AS vendor_best FROM v_net JOIN v_vendors USING (product_name)
           WHERE vendor = 'vendor1' GROUP BY group_label) v USING (group_label)
WHERE rk = 1""",
    ),
)
def win_best_per_aspect(spark, sf):
    vendors = (
        i.table(spark, sf, "documents")
        .groupBy(F.col("source").alias("product_name"))
        .agg(F.concat(F.lit("vendor"), (F.min("doc_id") % 4).cast("string")).alias("vendor"))
    )
    return marts.best_per_aspect(ch.net(spark, sf), vendors, "vendor1")


# -- scorer acceptance over labelled documents ------------------------------------------

V_PAIRS = (
    "v_pairs",
    """
SELECT CAST(d.doc_id AS STRING) AS review_id, d.text AS sentence,
  CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS expected
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)


@query(
    "qa_scorer_accept",
    with_sql(
        V_PAIRS,
        ("v_got", ch.scored_rows("v_pairs")),
        query=f"""
SELECT *, CASE WHEN pass_pct >= 100 THEN 'pass' WHEN pass_pct >= 75 THEN 'warning' ELSE 'fail' END AS band FROM (
SELECT expected, CAST(count(*) AS BIGINT) AS n_pairs,
  CAST(count(*) FILTER (sentiment_label = 'negative') AS BIGINT) AS got_negative,
  CAST(count(*) FILTER (sentiment_label = 'neutral') AS BIGINT) AS got_neutral,
  CAST(count(*) FILTER (sentiment_label = 'positive') AS BIGINT) AS got_positive,
  {pct("(SELECT count(*) FROM v_got WHERE sentiment_label = expected)", "(SELECT count(*) FROM v_got)")} AS pass_pct
FROM v_got GROUP BY expected)""",
    ),
)
def qa_scorer_accept(spark, sf):
    from reviewlens.operators.quality import scorer_acceptance

    pairs = i._sql(spark, sf, V_PAIRS[1], "documents", "labels")
    return scorer_acceptance(ch.lexicon_score(pairs))
