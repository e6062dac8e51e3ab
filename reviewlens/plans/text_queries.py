"""Text columns over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import text as tx
from reviewlens.operators import topics as tp
from reviewlens.plans import chain as ch
from reviewlens.plans import inputs as i
from reviewlens.plans.chain import pct
from reviewlens.plans.inputs import with_sql
from reviewlens.plans.registry import query

# Documents with the defects the cleaning is for: escaped line breaks, null tokens, leaked titles, abbreviations.
V_DIRTY = (
    "v_dirty",
    r"""
SELECT doc_id, lang, CASE CAST(doc_id % 10 AS INT) WHEN 0 THEN 'nan' WHEN 1 THEN concat('  ', text, '\n', lang, '\r\nend ')
  WHEN 2 THEN concat(text, ' Shown here. Powerful Yet Pricey Suite with')
  WHEN 3 THEN concat('AP aging and the fp&a team, GL and POS: ', text, ' 1099 W-2 SKUs kpi.')
  WHEN 4 THEN lang ELSE text END AS text
FROM documents""",
)


def dirty(spark, sf):
    text = F.expr(
        r"""CASE CAST(doc_id % 10 AS INT) WHEN 0 THEN 'nan' WHEN 1 THEN concat('  ', text, r'\n', lang, r'\r\nend ')
  WHEN 2 THEN concat(text, ' Shown here. Powerful Yet Pricey Suite with')
  WHEN 3 THEN concat('AP aging and the fp&a team, GL and POS: ', text, ' 1099 W-2 SKUs kpi.')
  WHEN 4 THEN lang ELSE text END"""
    )
    return i.table(spark, sf, "documents").select("doc_id", "lang", text.alias("text"))


CLEAN = (
    r"(SELECT doc_id, lang, CASE WHEN c NOT IN ('nan', 'None', '') THEN c END AS c FROM (SELECT doc_id, lang, "
    r"trim(regexp_replace(regexp_replace(text, '\\r\\n|\\n|\\r', ' ', 'g'), '\s+', ' ', 'g')) AS c FROM v_dirty))"
)
LEAK = r"\.\s+[A-Z][^.!?]{10,120}[^.!?\s]$"


def expand_sql(column: str) -> str:
    """All replacements in SQL. The word boundary there knows ASCII only, so every other letter stands between two
    ASCII word marks while the replacements run."""
    expr = rf"regexp_replace({column}, '([^\x00-\x7F])', 'Q0Z\1Q0Z', 'g')"
    for pattern, full in cfg.ABBREVIATIONS:
        expr = rf"regexp_replace({expr}, '\b{pattern}\b', '{full}', 'gi')"
    return rf"regexp_replace({expr}, 'Q0Z([^\x00-\x7F])Q0Z', '\1', 'g')"


@query("txt_clean", with_sql(V_DIRTY, query=f"SELECT doc_id, sha256(c) AS text_hash, length(c) AS n_chars FROM {CLEAN}"))
def txt_clean(spark, sf):
    return dirty(spark, sf).select("doc_id", tx.clean(F.col("text")).alias("c")).select(
        "doc_id", F.sha2("c", 256).alias("text_hash"), F.length("c").cast("bigint").alias("n_chars")
    )


@query(
    "txt_strip_title",
    with_sql(
        V_DIRTY,
        query=rf"""
SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '{LEAK}', '.')) AS text_hash FROM v_dirty""",
    ),
)
def txt_strip_title(spark, sf):
    return dirty(spark, sf).select("doc_id", F.sha2(tx.strip_title(F.col("text")), 256).alias("text_hash"))


@query(
    "txt_leak_rate",
    with_sql(
        V_DIRTY,
        query=rf"""
SELECT lang, CAST(count(*) AS BIGINT) AS n_rows,
  {pct(rf"count(*) FILTER (regexp_matches(regexp_replace(text, '^\s+|\s+$', '', 'g'), '{LEAK}'))", "count(*)")} AS leak_pct
FROM v_dirty GROUP BY lang""",
    ),
)
def txt_leak_rate(spark, sf):
    from reviewlens.functions.numeric import share_pct

    n = F.count(F.lit(1))
    leaks = F.count_if(tx.has_title_leak(F.col("text")))
    return dirty(spark, sf).groupBy("lang").agg(n.alias("n_rows"), share_pct(leaks, n).alias("leak_pct"))


@query("txt_expand_abbrev", with_sql(V_DIRTY, query=f"SELECT doc_id, sha256({expand_sql('text')}) AS text_hash FROM v_dirty"))
def txt_expand_abbrev(spark, sf):
    return dirty(spark, sf).select("doc_id", F.sha2(tx.expand_abbreviations(F.col("text")), 256).alias("text_hash"))


@query(
    "flt_min_chars",
    with_sql(
        V_DIRTY,
        query=f"""
SELECT doc_id, lang, CASE WHEN length(e) >= {cfg.MIN_CHARS} THEN length(e) END AS n_chars
FROM (SELECT doc_id, lang, {expand_sql("c")} AS e FROM {CLEAN})""",
    ),
)
def flt_min_chars(spark, sf):
    kept = tp.topic_texts(dirty(spark, sf).withColumn("text_field", F.lit("likes")))
    return kept.select("doc_id", "lang", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "txt_json_payload",
    """
SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
  CASE event_id % 4 WHEN 2 THEN concat('because ', event_type) END AS reasoning, (event_id % 4 = 3) AS failed
FROM events""",
)
def txt_json_payload(spark, sf):
    events = i.table(spark, sf, "events")
    kind = F.col("event_id") % 4
    response = (
        F.when(kind == 0, F.concat(F.lit(" "), "props", F.lit("\n")))
        .when(kind == 1, F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone")))
        .when(
            kind == 2,
            F.concat(F.lit("<reasoning> because "), "event_type", F.lit("</reasoning><output>\n"), "props", F.lit(" </output>")),
        )
        .otherwise(F.concat(F.lit("no json "), "event_type"))
    )
    rows = events.select("event_id", response.alias("response"))
    parsed = rows.withColumn("payload", tx.json_payload(F.col("response")))
    return parsed.select(
        "event_id",
        F.try_variant_get("payload", "$.k", "string").alias("k"),
        tx.reasoning(F.col("response")).alias("reasoning"),
        F.col("payload").isNull().alias("failed"),
    )


@query("kw_label", with_sql(i.V_LONG, ch.V_INFO, ch.V_INFO_LABELLED, query="SELECT text_field, topic_id, top_keywords, label FROM v_infol"))
def kw_label(spark, sf):
    return ch.topic_info(spark, sf).select("text_field", "topic_id", "top_keywords", "label")


_PHRASES = ", ".join(f"'{p}'" for p in cfg.PRODUCT_STOP)


@query(
    "kw_product_cluster",
    with_sql(
        i.V_LONG,
        ch.V_INFO,
        ("v_top", "SELECT *, list_transform(string_split(lower(top_keywords), ',')[1:3], lambda k: trim(k)) AS top FROM v_info"),
        query=f"""
SELECT text_field, topic_id,
  len(list_filter(top, lambda t: len(list_filter([{_PHRASES}], lambda p: contains(t, p))) > 0)) = len(top) AS by_substring,
  len(list_filter(top, lambda t: len(list_filter([{_PHRASES}], lambda p: contains(' ' || t || ' ', ' ' || p || ' '))) > 0)) = len(top)
    AS by_token
FROM v_top""",
    ),
)
def kw_product_cluster(spark, sf):
    kw = F.col("top_keywords")
    return ch.topic_info(spark, sf).select(
        "text_field",
        "topic_id",
        tx.names_only_products(kw).alias("by_substring"),
        tx.names_only_products(kw, mode="token").alias("by_token"),
    )
