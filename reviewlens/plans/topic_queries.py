"""Topic words over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import topics as tp
from reviewlens.plans import chain as ch
from reviewlens.plans import inputs as i
from reviewlens.plans.inputs import r, with_sql
from reviewlens.plans.registry import query

KEYS = ["text_field", "topic_id"]
_STOP = ", ".join(f"'{w}'" for w in sorted(set(tp.DEFAULT_STOP)))
V_TERMS = (
    "v_terms",
    rf"""
SELECT text_field, topic_id, unnest(kept || pairs) AS term FROM (
  SELECT *, list_transform(kept[2:], lambda w, n: kept[n] || ' ' || w) AS pairs FROM (
    SELECT text_field, topic_id,
      list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({_STOP})) AS kept
    FROM v_long))""",
)
V_COUNTS = ("v_counts", "SELECT text_field, topic_id, term, CAST(count(*) AS BIGINT) AS n FROM v_terms GROUP BY ALL")
V_VOCAB = (
    "v_vocab",
    f"""
SELECT text_field, term, doc_freq, term_total, n_topics FROM (
  SELECT text_field, term, CAST(count(*) AS BIGINT) AS doc_freq, CAST(sum(n) AS BIGINT) AS term_total FROM v_counts GROUP BY ALL)
JOIN (SELECT text_field, CAST(count(DISTINCT topic_id) AS BIGINT) AS n_topics FROM v_counts GROUP BY ALL) USING (text_field)
WHERE doc_freq >= {cfg.MIN_DF} AND doc_freq <= n_topics * {cfg.MAX_DF}::DOUBLE""",
)
V_WEIGHTS = (
    "v_weights",
    """
SELECT k.text_field, k.topic_id, k.term, k.n,
  sqrt(k.n / t.topic_total::DOUBLE) * ln(1.0::DOUBLE + floor(m.mean_total) / k.term_total::DOUBLE) AS weight
FROM (SELECT c.*, v.term_total FROM v_counts c JOIN v_vocab v USING (text_field, term)) k
JOIN (SELECT text_field, topic_id, sum(n) AS topic_total FROM v_counts JOIN v_vocab USING (text_field, term) GROUP BY ALL) t
  USING (text_field, topic_id)
JOIN (SELECT text_field, avg(topic_total) AS mean_total FROM (
  SELECT text_field, topic_id, sum(n) AS topic_total FROM v_counts JOIN v_vocab USING (text_field, term) GROUP BY ALL)
  GROUP BY ALL) m USING (text_field)""",
)
V_TOP = (
    "v_top",
    f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY text_field, topic_id
  ORDER BY floor(weight * 1e9::DOUBLE + 0.5::DOUBLE) DESC, term) AS INTEGER) AS term_rank FROM v_weights)
WHERE term_rank <= {cfg.TOP_TERMS}""",
)
_PHRASES = ", ".join(f"'{p}'" for p in cfg.ALL_STOP)
V_CLEAN = (
    "v_cleank",
    f"""
SELECT text_field, topic_id, string_agg(term, ', ' ORDER BY term_rank) AS top_keywords FROM v_top
WHERE term NOT IN ({_PHRASES}) AND length(term) > 2 AND NOT regexp_full_match(term, '[0-9]+')
  AND len(list_filter([{_PHRASES}], lambda p: starts_with(term, p || ' ') OR ends_with(term, ' ' || p))) = 0
GROUP BY ALL""",
)
TERMS = (i.V_LONG, V_TERMS, V_COUNTS)
WEIGHTS = (*TERMS, V_VOCAB, V_WEIGHTS)
TOP = (*WEIGHTS, V_TOP)


def docs(spark, sf):
    return i.reviews_long(spark, sf).select("text_field", "topic_id", "text")


def weights(spark, sf):
    return tp.ctfidf(docs(spark, sf), KEYS)


def top(spark, sf):
    return tp.top_terms(weights(spark, sf), KEYS)


@query("tm_tokens", with_sql(*TERMS, query="SELECT * FROM v_counts"))
def tm_tokens(spark, sf):
    return tp.term_counts(docs(spark, sf), KEYS)


@query("tm_vocab", with_sql(*TERMS, V_VOCAB, query="SELECT * FROM v_vocab"))
def tm_vocab(spark, sf):
    return tp.vocabulary_counts(docs(spark, sf), KEYS).select("text_field", "term", "doc_freq", "term_total", "n_topics").distinct()


# Counts first, then the joins: the texts are cut into terms once.
ONCE = ("v_counts", "v_vocab")


@query("tm_ctfidf", with_sql(*WEIGHTS, query=f"SELECT text_field, topic_id, term, n, {r('weight', 6)} AS weight FROM v_weights", once=ONCE))
def tm_ctfidf(spark, sf):
    return weights(spark, sf).withColumn("weight", round_half_up(F.col("weight"), 6))


@query("tm_top_terms", with_sql(*TOP, query="SELECT text_field, topic_id, term, n, term_rank FROM v_top"))
def tm_top_terms(spark, sf):
    return top(spark, sf).drop("weight")


@query("tm_clean_keywords", with_sql(*TOP, V_CLEAN, query="SELECT * FROM v_cleank"))
def tm_clean_keywords(spark, sf):
    return tp.clean_keywords(top(spark, sf), KEYS)


# -- grouping of topics ---------------------------------------------------------------------

INFO = (i.V_LONG, ch.V_INFO)


@query(
    "gr_enrich",
    with_sql(
        *INFO,
        query=f"""
SELECT text_field, topic_id, CASE WHEN short THEN concat(k, ', gl') ELSE k END AS top_keywords,
  CASE WHEN short THEN concat(k, ', general ledger') ELSE k END AS resolved_keywords,
  CASE WHEN k = '{cfg.UNLABELLED}' THEN 'Unlabelled topic' WHEN short THEN concat('Keywords: ', k, ', gl') ELSE concat('Keywords: ', k) END AS plain_description,
  'other' AS candidate_categories, k = '{cfg.UNLABELLED}' AS is_noise,
  CASE WHEN k = '{cfg.UNLABELLED}' THEN 'No keywords available' END AS noise_reason
FROM (SELECT text_field, topic_id, top_keywords AS k, top_keywords <> '{cfg.UNLABELLED}' AND topic_id % 3 = 0 AS short FROM v_info WHERE topic_id <> -1)""",
    ),
)
def gr_enrich(spark, sf):
    """Half of the topics are enriched in a first run; the second run adds only the others. A third of them have an abbreviation
    among their keywords."""
    from reviewlens.operators import grouping as gr
    from reviewlens.session import ensure_checkpoint_dir, scratch_path

    path = scratch_path(spark, "enrichment")
    keywords = F.col("top_keywords")
    short = (keywords != cfg.UNLABELLED) & (F.col("topic_id") % 3 == 0)
    info = ch.topic_info(spark, sf).withColumn("top_keywords", F.when(short, F.concat(keywords, F.lit(", gl"))).otherwise(keywords))
    gr.enrich_and_cache(info.filter("topic_id % 2 = 0"), path)
    rows = gr.enrich_and_cache(info, path)
    return rows.withColumn("candidate_categories", F.array_join("candidate_categories", ","))


CLAIMS_SQL = """
SELECT DISTINCT l.text_field, l.topic_id, m.macro_group FROM v_long l JOIN v_map m ON l.topic_id = m.topic_id
UNION ALL SELECT DISTINCT text_field, topic_id, 'setup' FROM v_long WHERE topic_id = 0 AND text_field = 'likes'"""


@query(
    "gr_audit",
    with_sql(
        i.V_LONG,
        i.V_MAP,
        ("v_claims", CLAIMS_SQL),
        ("v_sizes", "SELECT text_field, macro_group, count(DISTINCT topic_id) AS n FROM v_claims WHERE macro_group <> 'noise' GROUP BY ALL"),
        query="""
SELECT text_field, 'claimed_more_than_once' AS issue, CAST(topic_id AS VARCHAR) AS subject, CAST(count(*) AS BIGINT) AS n
FROM v_claims GROUP BY text_field, topic_id HAVING count(*) > 1
UNION ALL
SELECT DISTINCT text_field, 'not_grouped', CAST(topic_id AS VARCHAR), CAST(0 AS BIGINT) FROM v_long l
WHERE topic_id <> -1 AND NOT EXISTS (SELECT 1 FROM v_claims c WHERE c.text_field = l.text_field AND c.topic_id = l.topic_id)
UNION ALL
SELECT text_field, 'oversized_group', macro_group, n FROM v_sizes WHERE n > 8
UNION ALL
SELECT text_field, 'undersized_group', macro_group, n FROM v_sizes WHERE n <= 2
UNION ALL
SELECT text_field, 'group_count', 'groups', count(*) FROM v_sizes GROUP BY text_field HAVING count(*) NOT BETWEEN 10 AND 20""",
    ),
)
def gr_audit(spark, sf):
    from reviewlens.operators import grouping as gr

    topics = i.reviews_long(spark, sf).select("text_field", "topic_id").distinct()
    claims = topics.join(i.topic_map(spark).drop("group_label"), "topic_id").select("text_field", "topic_id", "macro_group")
    extra = topics.filter("topic_id = 0 AND text_field = 'likes'").withColumn("macro_group", F.lit("setup"))
    return gr.audit(claims.unionByName(extra), topics)
