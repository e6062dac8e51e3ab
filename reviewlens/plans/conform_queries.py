"""Projection, conforming and coercion over raw items in three layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import coerce as co
from reviewlens.functions import text as tx
from reviewlens.operators import conform
from reviewlens.operators import quality
from reviewlens.plans import inputs as i
from reviewlens.plans import raw_inputs as ri
from reviewlens.plans.inputs import r, with_sql
from reviewlens.plans.registry import query
from reviewlens.plans.source_queries import base_reviews, unified

# What the unified columns must be, straight from the plain columns.
V_UNI = (
    "v_uni",
    r"""
SELECT *, concat('P-', product_key) AS product_id, concat('Product ', product_key) AS product_name,
  nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), '') AS likes,
  cons AS dislikes,
  CASE WHEN source_actor = 'jupri' AND doc_id % 2 = 0 THEN concat('use ', lang)
       WHEN source_actor = 'focused_vanguard' THEN concat('body ', lang) END AS use_case,
  CASE doc_id % 4 WHEN 0 THEN CAST(doc_id % 5 + 1 AS DOUBLE) + 0.55 WHEN 2 THEN CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating,
  CASE WHEN source_actor = 'jupri' THEN industry END AS reviewer_industry,
  CASE WHEN source_actor = 'jupri' AND doc_id % 11 <> 0 THEN lang END AS reviewer_location
FROM v_raw""",
)
V_ID = (
    "v_id",
    """
SELECT *, coalesce(native_id, concat('hash-', substr(sha256(concat(product_id, '|', reviewer, '|', published, '|',
  coalesce(substr(likes, 1, 100), 'None'), '|', substr(dislikes, 1, 100))), 1, 16))) AS review_id
FROM v_uni""",
)
# Bonus columns exist for the first layout only.
V_BASE = (
    "v_base",
    r"""
SELECT *, CASE WHEN source_actor = 'jupri' THEN concat('T ', CAST(doc_id AS STRING)) END AS review_title,
  CASE WHEN source_actor = 'jupri' THEN review_type END AS bonus_type,
  CASE WHEN source_actor = 'jupri' AND doc_id % 11 <> 0 THEN concat('R-', lang) END AS reviewer_region,
  CASE WHEN source_actor = 'jupri' THEN concat('http://x/', CAST(doc_id AS STRING)) END AS review_url,
  CASE WHEN source_actor = 'jupri' THEN published END AS review_submitted_at,
  coalesce(source_actor = 'jupri' AND review_type IN ('g2gives', 'g2_incentivized'), false) AS is_incentivized,
  CASE WHEN source_actor = 'jupri' THEN CASE switch_kind WHEN 'object' THEN concat(origin_a, ' | ', origin_b)
       WHEN 'list' THEN origin_a END END AS switched_from_product,
  CASE WHEN source_actor = 'jupri' THEN CASE switch_kind WHEN 'object' THEN concat('why ', lang) WHEN 'reason' THEN 'only' END
       END AS switched_from_reason,
  CASE doc_id % 4 WHEN 0 THEN DATE '2020-01-02' + CAST(doc_id % 1500 AS INT) WHEN 2 THEN NULL
       ELSE DATE '2020-01-01' + CAST(doc_id % 1500 AS INT) END AS utc_date
FROM v_id""",
)
RAW = (ri.V_RAW, V_UNI)
FULL = (ri.V_RAW, V_UNI, V_ID, V_BASE)


def _item_by_source(spark, sf, a, b, c):
    """A path per layout over the raw items."""
    actor, item = F.col("source_actor"), F.col("item")
    paths = dict(zip(cfg.LAYOUTS, (a, b, c)))
    return ri.raw_items(spark, sf), co.by_source(actor, lambda lay: co.get_path(item, paths[lay.key]))


@query(
    "prj_path",
    with_sql(
        i.V_CONV,
        query="""
SELECT CAST(event_id AS STRING) AS row_id, json_extract_string(props, '$.k') AS found, CAST(NULL AS VARCHAR) AS missing_key,
       CAST(NULL AS VARCHAR) AS scalar_mid_path, CAST(NULL AS VARCHAR) AS bad_index
FROM events""",
    ),
)
def prj_path(spark, sf):
    item = F.try_parse_json("props")
    return i.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("row_id"),
        co.get_path(item, "k").alias("found"),
        co.get_path(item, "k2").alias("missing_key"),
        co.get_path(item, "k.0.name").alias("scalar_mid_path"),
        co.get_path(item, "k.3").alias("bad_index"),
    )


@query(
    "prj_fieldmap",
    with_sql(
        *RAW,
        query="""
SELECT doc_id, source_actor, native_id AS review_id, sha256(likes) AS likes_hash, dislikes, use_case,
  rating AS overall_rating,
  CASE WHEN source_actor = 'samstorm' THEN CAST(doc_id % 5 AS DOUBLE) + 0.5 END AS ease_of_use,
  CASE WHEN source_actor = 'samstorm' THEN CAST(doc_id % 4 AS DOUBLE) END AS support_rating,
  CASE WHEN source_actor = 'samstorm' THEN 4.0::DOUBLE END AS value_rating,
  CASE WHEN source_actor = 'samstorm' THEN CAST(doc_id % 11 AS DOUBLE) END AS likely_to_recommend,
  reviewer AS reviewer_name, lang AS reviewer_title, product_key AS reviewer_company_size,
  reviewer_industry, reviewer_location, published AS review_date,
  CAST(NULL AS VARCHAR) AS recommendations, CAST(NULL AS VARCHAR) AS time_using_product, CAST(NULL AS BOOLEAN) AS is_verified,
  CAST(NULL AS DOUBLE) AS product_overall_rating, CAST(NULL AS BIGINT) AS product_review_count
FROM v_uni""",
    ),
)
def prj_fieldmap(spark, sf):
    mapped = conform.map_fields(ri.raw_items(spark, sf), ["doc_id", "source_actor"])
    return mapped.withColumn("likes_hash", F.sha2("likes", 256)).drop("likes", "is_incentivized")


@query(
    "prj_coerce_float",
    with_sql(*RAW, query="SELECT doc_id, score AS raw_value, rating AS value FROM v_uni"),
)
def prj_coerce_float(spark, sf):
    items, score = _item_by_source(spark, sf, "score", "overallRating", "rating")
    return items.select("doc_id", score.alias("raw_value"), co.to_float(score).alias("value"))


@query(
    "prj_coerce_int",
    """
SELECT o_orderkey, TRY_CAST(nullif(regexp_replace(concat('$', CAST(o_custkey AS VARCHAR), '.', CAST(o_orderkey % 10 AS VARCHAR)),
       '[^0-9]', '', 'g'), '') AS BIGINT) AS dotted, o_custkey AS signed,
       TRY_CAST(nullif(regexp_replace(o_orderpriority, '[^0-9]', '', 'g'), '') AS BIGINT) AS priority,
       CAST(NULL AS BIGINT) AS none
FROM orders""",
)
def prj_coerce_int(spark, sf):
    cust = F.col("o_custkey").cast("string")
    return i.table(spark, sf, "orders").select(
        "o_orderkey",
        co.to_int(F.concat(F.lit("$"), cust, F.lit("."), (F.col("o_orderkey") % 10).cast("string"))).alias("dotted"),
        co.to_int(F.concat(F.lit("-"), cust)).alias("signed"),
        co.to_int("o_orderpriority").alias("priority"),
        co.to_int(F.col("o_orderstatus")).alias("none"),
    )


@query(
    "prj_coerce_bool",
    """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN NULL WHEN 3 THEN false ELSE value > 20 END AS flag
FROM events""",
)
def prj_coerce_bool(spark, sf):
    raw = F.expr(
        "CASE event_id % 5 WHEN 0 THEN 'Verified' WHEN 1 THEN 'YES' WHEN 2 THEN NULL WHEN 3 THEN event_type"
        " ELSE CAST(value > 20 AS STRING) END"
    )
    return i.table(spark, sf, "events").select("event_id", co.to_bool(raw).alias("flag"))


@query(
    "prj_coerce_str",
    r"""
SELECT doc_id, sha256(nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), '')) AS text_hash,
       nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END), '') AS padded
FROM documents""",
)
def prj_coerce_str(spark, sf):
    padded = F.when(F.col("doc_id") % 3 == 0, " \t\n").otherwise(F.concat(F.lit("\n "), "lang", F.lit(" ")))
    return i.table(spark, sf, "documents").select(
        "doc_id",
        F.sha2(co.to_str(F.concat(F.lit(" \t"), "text", F.lit(" \n"))), 256).alias("text_hash"),
        co.to_str(padded).alias("padded"),
    )


@query(
    "prj_inject",
    with_sql(
        *RAW,
        query=f"""
SELECT doc_id, product_key, source_actor, product_id, product_name, '{ri.SCRAPED_AT}' AS scraped_at FROM v_uni""",
    ),
)
def prj_inject(spark, sf):
    return conform.inject(ri.raw_items(spark, sf).drop("item"), ri.product_dimension(spark, sf))


@query(
    "prj_bonus",
    with_sql(
        *FULL,
        query="""
SELECT doc_id,
  CASE source_actor
    WHEN 'jupri' THEN concat_ws(',', 'helpful', CASE WHEN doc_id % 11 <> 0 THEN 'primary' END, 'product_id', 'product_slug',
      CASE WHEN doc_id % 11 <> 0 THEN 'region' END, 'submitted', CASE WHEN switch_kind <> 'none' THEN 'switched_from' END,
      'title', CASE WHEN review_type IS NOT NULL THEN 'type' END, 'updated', 'url')
    WHEN 'samstorm' THEN 'featuresRating,reviewTitle,sourceUrl'
    ELSE concat_ws(',', CASE WHEN record_platform IS NOT NULL THEN 'sourcePlatform' END, 'sourceUrl') END AS bonus_keys,
  bonus_type, review_submitted_at,
  CASE source_actor WHEN 'jupri' THEN CAST(doc_id % 100 AS VARCHAR) WHEN 'samstorm' THEN CAST(doc_id % 3 AS VARCHAR)
    ELSE record_platform END AS one_value
FROM v_base""",
    ),
)
def prj_bonus(spark, sf):
    bonus = ri.raw_items(spark, sf).select("doc_id", co.bonus_json(F.col("item"), F.col("source_actor")).alias("b"))
    value = lambda k: F.get_json_object("b", f"$.{k}")
    return bonus.select(
        "doc_id",
        F.array_join(F.array_sort(F.json_object_keys("b")), ",").alias("bonus_keys"),
        value("type").alias("bonus_type"),
        value("submitted").alias("review_submitted_at"),
        F.coalesce(value("product_id"), value("featuresRating"), value("sourcePlatform")).alias("one_value"),
    )


@query(
    "prj_platform",
    with_sql(
        *RAW,
        query="""
SELECT doc_id, CASE source_actor WHEN 'jupri' THEN 'g2' WHEN 'samstorm' THEN 'capterra'
  ELSE coalesce(lower(record_platform), 'multi') END AS source_platform
FROM v_uni""",
    ),
)
def prj_platform(spark, sf):
    return ri.raw_items(spark, sf).select("doc_id", co.platform(F.col("item"), F.col("source_actor")).alias("source_platform"))


@query("prj_stable_id", with_sql(ri.V_RAW, V_UNI, V_ID, query="SELECT review_id, product_id, reviewer AS reviewer_name FROM v_id"))
def prj_stable_id(spark, sf):
    return unified(spark, sf).select("review_id", "product_id", "reviewer_name")


@query(
    "prj_confidence",
    with_sql(
        ri.V_RAW, V_UNI, V_ID,
        query=f"""
SELECT review_id, {r("(4 - CAST(likes IS NULL AS INT) + CAST(rating IS NOT NULL AS INT)) / 5.0::DOUBLE", 2)} AS extraction_confidence
FROM v_id""",
    ),
)
def prj_confidence(spark, sf):
    return unified(spark, sf).select("review_id", "extraction_confidence")


@query(
    "prj_quarantine",
    with_sql(
        ri.V_RAW,
        query="""
SELECT doc_id, CASE doc_id % 50 WHEN 7 THEN 'bad_json' WHEN 8 THEN 'not_object' WHEN 9 THEN 'unknown_source' ELSE 'accepted' END
  AS outcome
FROM v_raw""",
    ),
)
def prj_quarantine(spark, sf):
    kind = F.col("doc_id") % 50
    broken = ri.raw_text(spark, sf).withColumns(
        {
            "item_json": F.when(kind == 7, '{"id": ').when(kind == 8, "[1, 2]").otherwise(F.col("item_json")),
            "source_actor": F.when(kind == 9, "elsewhere").otherwise(F.col("source_actor")),
        }
    )
    checked = conform.with_reject_reason(broken)
    good = conform.accepted(checked).select("doc_id", F.lit("accepted").alias("outcome"))
    return good.unionByName(conform.quarantined(checked).select("doc_id", F.col("reject_reason").alias("outcome")))


BASE_COLUMNS = """review_id, review_title, bonus_type AS review_type, reviewer_region, review_url, review_submitted_at,
  is_incentivized"""


@query("prj_bonus_flat", with_sql(*FULL, query=f"SELECT {BASE_COLUMNS} FROM v_base"))
def prj_bonus_flat(spark, sf):
    return conform.flatten_bonus(unified(spark, sf).drop("is_incentivized")).select(
        "review_id", "review_title", "review_type", "reviewer_region", "review_url", "review_submitted_at", "is_incentivized"
    )


@query(
    "prj_switched",
    with_sql(*FULL, query="SELECT review_id, switched_from_product, switched_from_reason FROM v_base"),
)
def prj_switched(spark, sf):
    bonus = F.try_parse_json("bonus_data")
    return unified(spark, sf).select(
        "review_id",
        co.switched_products(bonus).alias("switched_from_product"),
        co.switched_reason(bonus).alias("switched_from_reason"),
    )


@query("prj_incentivized", with_sql(*FULL, query="SELECT review_id, is_incentivized FROM v_base"))
def prj_incentivized(spark, sf):
    kind = co.bonus_text(F.try_parse_json("bonus_data"), "type")
    return unified(spark, sf).select("review_id", co.incentivized(kind).alias("is_incentivized"))


@query("prj_date", with_sql(*FULL, query="SELECT doc_id, published, utc_date AS review_date FROM v_base"))
def prj_date(spark, sf):
    items, published = _item_by_source(spark, sf, "date.published", "publishedDate", "publishedAt")
    return items.select("doc_id", published.alias("published"), co.to_utc_date(published).alias("review_date"))


@query(
    "prj_drop_static",
    with_sql(
        *FULL,
        query="SELECT review_id, product_id, product_name, utc_date AS review_date, dislikes, use_case, "
        "reviewer AS reviewer_name, sha256(likes) AS likes_hash, rating AS overall_rating FROM v_base",
    ),
)
def prj_drop_static(spark, sf):
    kept = base_reviews(spark, sf)
    gone = [c for c in cfg.NULL_COLUMNS + cfg.PIPELINE_COLUMNS if c in kept.columns]
    assert not gone, gone
    return kept.select(
        "review_id", "product_id", "product_name", "review_date", "dislikes", "use_case", "reviewer_name",
        F.sha2("likes", 256).alias("likes_hash"), "overall_rating",
    )


META_SQL = """
SELECT review_id, product_id, product_name,
  CASE source_actor WHEN 'jupri' THEN 'g2' WHEN 'samstorm' THEN 'capterra' ELSE coalesce(lower(record_platform), 'multi') END
    AS source_platform,
  utc_date AS review_date, review_submitted_at, rating AS overall_rating, reviewer AS reviewer_name, lang AS reviewer_title,
  product_key AS reviewer_company_size, reviewer_industry, reviewer_location, reviewer_region, review_title,
  bonus_type AS review_type, is_incentivized, review_url, switched_from_product, switched_from_reason
FROM v_base"""
V_META = ("v_meta", META_SQL)


def doubled_reviews(spark, sf):
    """Every third review twice, the later copy under another name."""
    reviews = base_reviews(spark, sf).withColumn("ingest_seq", F.lit(0))
    again = reviews.filter(F.crc32("review_id") % 3 == 0).withColumns(
        {"ingest_seq": F.lit(1), "reviewer_name": F.concat(F.lit("again "), "reviewer_name")}
    )
    return reviews.unionByName(again)


META_TYPES = {"review_date": "date", "overall_rating": "double", "is_incentivized": "boolean"}


@query(
    "agg_manifest",
    with_sql(
        *FULL, V_META,
        query="\nUNION ALL\n".join(
            f"""SELECT {n} AS position, '{c}' AS column_name, '{META_TYPES.get(c, "string")}' AS data_type,
  {r(f"(count(*) - count({c}))::DOUBLE * 100.0 / count(*)::DOUBLE", 1)} AS null_pct, substr(CAST(min({c}) AS VARCHAR), 1, 50) AS example
FROM v_meta""" for n, c in enumerate(cfg.META_COLUMNS, 1)
        ),
    ),
)
def agg_manifest(spark, sf):
    return quality.manifest(conform.select_present(base_reviews(spark, sf), cfg.META_COLUMNS))


@query("prj_meta", with_sql(*FULL, query=META_SQL))
def prj_meta(spark, sf):
    return conform.build_meta(doubled_reviews(spark, sf), "ingest_seq")


@query(
    "prj_reorder",
    with_sql(
        i.V_LONG,
        query="SELECT review_id, product_name, overall_rating, text_field, topic_id, 'x' AS extra FROM v_long",
    ),
)
def prj_reorder(spark, sf):
    shuffled = i.reviews_long(spark, sf).select(
        F.lit("x").alias("extra"), "topic_id", "text_field", "overall_rating", "product_name", "review_id"
    )
    return conform.reorder(shuffled, cfg.LONG_COLUMNS)


@query("ddp_first", with_sql(*FULL, query="SELECT review_id, reviewer AS reviewer_name FROM v_base"))
def ddp_first(spark, sf):
    from reviewlens.operators.dedup import keep_first

    return keep_first(doubled_reviews(spark, sf), ["review_id"], "ingest_seq").select("review_id", "reviewer_name")


# Every unified field in its order, from the plain columns.
_NO_TEXT, _SECOND = "CAST(NULL AS VARCHAR)", "source_actor = 'samstorm'"
UNIFIED_SQL = {
    "review_id": "review_id", "product_id": "product_id", "product_name": "product_name",
    "source_platform": "CASE source_actor WHEN 'jupri' THEN 'g2' WHEN 'samstorm' THEN 'capterra' ELSE coalesce(lower(record_platform), 'multi') END",
    "source_actor": "source_actor", "scraped_at": f"'{ri.SCRAPED_AT}'", "likes": "likes", "dislikes": "dislikes",
    "recommendations": _NO_TEXT, "use_case": "use_case", "overall_rating": "rating",
    "ease_of_use": f"CASE WHEN {_SECOND} THEN CAST(doc_id % 5 AS DOUBLE) + 0.5 END",
    "support_rating": f"CASE WHEN {_SECOND} THEN CAST(doc_id % 4 AS DOUBLE) END",
    "value_rating": f"CASE WHEN {_SECOND} THEN 4.0::DOUBLE END",
    "likely_to_recommend": f"CASE WHEN {_SECOND} THEN CAST(doc_id % 11 AS DOUBLE) END",
    "reviewer_name": "reviewer", "reviewer_title": "lang", "reviewer_company_size": "product_key",
    "reviewer_industry": "reviewer_industry", "reviewer_location": "reviewer_location", "time_using_product": _NO_TEXT,
    "review_date": "published", "is_verified": "CAST(NULL AS BOOLEAN)",
    "is_incentivized": "CASE WHEN source_actor = 'jupri' THEN CAST(NULL AS BOOLEAN) END",
    "product_overall_rating": "CAST(NULL AS DOUBLE)", "product_review_count": "CAST(NULL AS BIGINT)",
    "extraction_confidence": r("(4 - CAST(likes IS NULL AS INT) + CAST(rating IS NOT NULL AS INT)) / 5.0::DOUBLE", 2),
}


@query(
    "agg_field_coverage",
    with_sql(
        *FULL,
        query="\nUNION ALL\n".join(
            f"""SELECT {n} AS position, '{c}' AS column_name, CAST(count({e}) AS BIGINT) AS n_filled,
  {r(f"count({e})::DOUBLE * 100.0 / count(*)::DOUBLE", 1)} AS coverage_pct, substr(CAST(min({e}) AS VARCHAR), 1, 40) AS example
FROM v_base"""
            for n, (c, e) in enumerate(UNIFIED_SQL.items(), 1)
        ),
    ),
)
def agg_field_coverage(spark, sf):
    """All unified fields."""
    return quality.field_coverage(unified(spark, sf), list(cfg.UNIFIED_FIELDS))


LONG_PROFILE = [
    "review_id", "product_name", "text_field", "text", "reviewer_company_size", "overall_rating", "is_incentivized", "review_date",
    "switched_from_product", "topic_id",
]


@query(
    "agg_null_profile",
    with_sql(
        *FULL, V_META, i.V_LONG,
        query="\nUNION ALL\n".join(
            f"""SELECT '{out}' AS output, {n} AS position, '{c}' AS column_name,
  {r(f"(count(*) - count({c}))::DOUBLE * 100.0 / count(*)::DOUBLE", 1)} AS null_pct FROM v_{out}"""
            for out, columns in (("meta", cfg.META_COLUMNS), ("long", LONG_PROFILE)) for n, c in enumerate(columns, 1)
        ),
    ),
)
def agg_null_profile(spark, sf):
    """Both outputs: the table of reviews and the long table."""
    meta = quality.null_profile(conform.build_meta(base_reviews(spark, sf), "review_id"))
    long = quality.null_profile(i.reviews_long(spark, sf), LONG_PROFILE)
    return meta.withColumn("output", F.lit("meta")).unionByName(long.withColumn("output", F.lit("long")))


@query(
    "flt_lookback",
    with_sql(
        i.V_LONG,
        query="SELECT review_id, review_date FROM v_long WHERE review_date >= DATE '2022-06-01' - 90",
    ),
)
def flt_lookback(spark, sf):
    return conform.lookback(i.reviews_long(spark, sf), F.lit("2022-06-01").cast("date")).select("review_id", "review_date")


@query("flt_nonblank", with_sql(i.V_LONG, query=r"""
SELECT review_id, text_field FROM v_long WHERE doc_ok AND regexp_replace(text, '\s+', '', 'g') <> ''""".replace(
    "doc_ok", "CAST(review_id AS BIGINT) % 4 <> 0 AND text IS NOT NULL")))
def flt_nonblank(spark, sf):
    n = F.col("review_id").cast("bigint")
    text = F.when(n % 8 == 0, " \n").when(n % 4 == 0, F.lit(None)).otherwise(F.col("text"))
    rows = i.reviews_long(spark, sf).withColumn("text", text)
    return rows.filter(tx.nonblank(F.col("text"))).select("review_id", "text_field")
