"""Sources and sinks: write what a stage would have written, read it back, return it."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.operators import conform, reshape
from reviewlens.operators import quality
from reviewlens.plans import inputs as i
from reviewlens.plans import raw_inputs as ri
from reviewlens.plans.inputs import with_sql
from reviewlens.plans.registry import query
from reviewlens.session import scratch_path
from reviewlens.sources import raw, tables

ITEMS_PER_FILE = 500
ODD_NAME = 'rating,\n1 to "5"'


def land_snapshots(spark, sf):
    """Array files: the older run holds the even documents, the newer run all of them."""
    path = scratch_path(spark, "raw")
    items = ri.raw_text(spark, sf).withColumn("chunk", F.floor(F.col("doc_id") / (ITEMS_PER_FILE * 20)))
    older = items.filter("doc_id % 2 = 0").withColumn("run_ts", F.lit("20240501_000000"))
    raw.write_arrays(older.unionByName(items.withColumn("run_ts", F.lit("20240601_000000"))), path, "chunk")
    return path


RAW_LIKES = """
SELECT product_key, source_actor, native_id, reviewer,
       CASE WHEN source_actor = 'jupri' THEN 'answers' ELSE 'pros' END AS likes_key, length(text) AS n_chars, score
FROM v_raw
"""


def _items_summary(items):
    item = F.col("item")
    actor = F.col("source_actor")
    text = lambda p: F.try_variant_get(item, p, "string")
    pick = lambda a, b, c: F.when(actor == "jupri", text(a)).when(actor == "samstorm", text(b)).otherwise(text(c))
    return items.select(
        "run_ts",
        "source_actor",
        "product_key",
        pick("$.id", "$.reviewId", "$.id").alias("native_id"),
        pick("$.name", "$.reviewerName", "$.author").alias("reviewer"),
        pick("$.score", "$.overallRating", "$.rating").alias("score"),
        F.length(pick("$.answers[0]", "$.pros", "$.pros")).alias("n_chars"),
    )


@query(
    "src_raw_json",
    with_sql(
        i_raw := ri.V_RAW,
        query="""
SELECT t.run_ts, source_actor, product_key, native_id, reviewer, score, CAST(length(text) AS INTEGER) AS n_chars,
  CAST(NULL AS VARCHAR) AS reject_reason
FROM v_raw, (VALUES ('20240501_000000', 2), ('20240601_000000', 1)) AS t(run_ts, step) WHERE doc_id % t.step = 0
UNION ALL
SELECT '20240701_000000', 'jupri', k, NULL, NULL, NULL, NULL, reason FROM (VALUES ('cut', 'bad_json'), ('object', 'not_array')) AS v(k, reason)
""",
    ),
)
def src_raw_json(spark, sf):
    """Items of all snapshots, and the two files among them that cannot be used. Files beyond 16 kB are read by ranges here, so that
    both ways of reading take part."""
    path = land_snapshots(spark, sf)
    bad = [("cut", '[{"id": "1"}, {"id": "cut'), ("object", '{"id": "1"}')]
    for key, value in bad:
        folder = f"{path}/source_actor=jupri/product_key={key}/run_ts=20240701_000000"
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.text(folder)
    good, rejected = raw.read_raw(spark, path, split_above=16 << 10)
    rejects = raw.with_snapshot(rejected).select("run_ts", "source_actor", "product_key", "reject_reason")
    return _items_summary(good).unionByName(rejects, allowMissingColumns=True)


@query(
    "src_raw_latest",
    with_sql(
        i_raw,
        query="""
SELECT '20240601_000000' AS run_ts, source_actor, product_key, native_id, reviewer, score,
       CAST(length(text) AS INTEGER) AS n_chars
FROM v_raw""",
    ),
)
def src_raw_latest(spark, sf):
    return _items_summary(raw.read_latest(spark, land_snapshots(spark, sf)))


@query(
    "src_raw_inventory",
    with_sql(
        i_raw,
        query="""
SELECT source_actor, product_key, t.run_ts, CAST(count(DISTINCT floor(doc_id / 10000)) AS BIGINT) AS n_files
FROM v_raw, (VALUES ('20240501_000000', 2), ('20240601_000000', 1)) AS t(run_ts, step)
WHERE doc_id % t.step = 0 AND source_actor = 'jupri'
GROUP BY ALL""",
    ),
)
def src_raw_inventory(spark, sf):
    files = raw.inventory(spark, land_snapshots(spark, sf), actor="jupri")
    return files.groupBy("source_actor", "product_key", "run_ts").agg(F.count(F.lit(1)).alias("n_files"))


LONG_COLUMNS_SQL = """
SELECT review_id, product_name, text_field, length(text) AS n_chars, sha256(text) AS text_hash, overall_rating,
       is_incentivized, CAST(review_date AS STRING) AS review_date, switched_from_product, topic_id FROM v_long"""


@query("src_csv", with_sql(i.V_LONG, query=LONG_COLUMNS_SQL))
def src_csv(spark, sf):
    path = scratch_path(spark, "long-csv")
    long_df = i.reviews_long(spark, sf)
    tables.write_csv(long_df, path)
    back = tables.read_csv(spark, path, long_df.schema)
    return back.select(
        "review_id", "product_name", "text_field", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("text", 256).alias("text_hash"), "overall_rating", "is_incentivized",
        F.col("review_date").cast("string").alias("review_date"), "switched_from_product", "topic_id",
    )


@query(
    "src_union_csv",
    with_sql(
        i.V_LONG,
        query="""
SELECT review_id, product_name, text_field,
       CASE WHEN text_field = 'likes' THEN coalesce(CAST(overall_rating AS STRING), '') ELSE '' END AS overall_rating,
       CASE WHEN text_field = 'dislikes' THEN reviewer_company_size ELSE '' END AS reviewer_company_size,
       CASE WHEN text_field = 'use_case' THEN CAST(topic_id AS STRING) ELSE '' END AS topic_id
FROM v_long""",
    ),
)
def src_union_csv(spark, sf):
    base = scratch_path(spark, "union-csv")
    long_df = i.reviews_long(spark, sf)
    own = {"likes": "overall_rating", "dislikes": "reviewer_company_size", "use_case": "topic_id"}
    for field, column in own.items():
        part = long_df.filter(F.col("text_field") == field).select("review_id", "product_name", "text_field", column)
        if field == "likes":  # a name with a comma, quotes and a line break in it
            part = part.withColumnRenamed("overall_rating", ODD_NAME)
        tables.write_csv(part, f"{base}/{field}")
    return tables.union_csv(spark, base, skip="all_products_normalized").withColumnRenamed(ODD_NAME, "overall_rating")


RUN_LOG_SQL = (
    "v_log",
    """
SELECT CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS STRING) AS run_start,
       o_orderpriority AS actor_key, c_mktsegment AS product_key, concat('actor-', o_orderstatus) AS actor_id,
       concat('run-', CAST(o_orderkey AS STRING)) AS apify_run_id, concat('set-', CAST(o_custkey AS STRING)) AS dataset_id,
       CAST(o_orderkey % 2000 AS BIGINT) AS item_count, CAST(o_orderkey % 500 AS DOUBLE) / 10 AS duration_secs,
       concat('raw/', CAST(o_orderkey AS STRING), '.json') AS raw_path,
       c_name AS log_query, CAST(2000 AS BIGINT) AS log_limit
FROM orders JOIN customer ON o_custkey = c_custkey""",
)


def run_log(spark, sf):
    flat = i._sql(spark, sf, RUN_LOG_SQL[1], "orders", "customer")
    used = F.struct(F.col("log_query").alias("query"), F.col("log_limit").alias("limit"), F.col("log_limit").alias("maxReviews"))
    return flat.withColumn("input_used", used).drop("log_query", "log_limit")


def logged_runs(spark, sf):
    """The run log, appended in two parts and read back."""
    path = scratch_path(spark, "run-log")
    log = run_log(spark, sf)
    tables.append_run_log(log.filter("item_count < 1000"), path)
    tables.append_run_log(log.filter("item_count >= 1000"), path)
    return tables.read_run_log(spark, path)


@query("src_runlog", with_sql(RUN_LOG_SQL, query="SELECT * FROM v_log"))
def src_runlog(spark, sf):
    return logged_runs(spark, sf).select(
        "*", F.col("input_used.query").alias("log_query"), F.col("input_used.limit").alias("log_limit")
    ).drop("input_used")


def unified(spark, sf):
    return conform.unify(ri.raw_items(spark, sf), ri.product_dimension(spark, sf))


@query(
    "snk_normalized",
    with_sql(
        i_raw,
        query="""
SELECT source_actor, concat('P-', product_key) AS product_id, kind, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS BIGINT) AS likes_chars
FROM v_raw, (VALUES ('csv'), ('parquet')) AS t(kind) GROUP BY ALL""",
    ),
)
def snk_normalized(spark, sf):
    paths = tables.write_normalized(unified(spark, sf), scratch_path(spark, "normalized"))
    flat = tables.read_csv(spark, paths["csv"], unified(spark, sf).schema)
    full = spark.read.parquet(paths["parquet"]).select(*flat.columns)
    both = flat.withColumn("kind", F.lit("csv")).unionByName(full.withColumn("kind", F.lit("parquet")))
    return both.groupBy("source_actor", "product_id", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("likes")).alias("likes_chars")
    )


def base_reviews(spark, sf):
    return conform.base_reviews(unified(spark, sf))


def review_topics(spark, sf):
    """Doc topics and topic info for the reviews made from raw items."""
    long_df = i.reviews_long(spark, sf)
    docs = long_df.select(
        F.concat(F.lit("r"), "review_id").alias("review_id"), "text_field", "topic_id",
        (F.col("topic_id").cast("double") / 10).alias("probability"),
    )
    info = i.topic_map(spark)
    return docs, reshape.with_noise_flag(info)


@query(
    "snk_enriched",
    """
SELECT kind, copy, CAST(n AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM (
  SELECT 'reviews_meta' AS kind, count(DISTINCT doc_id) AS n FROM documents
  UNION ALL
  SELECT 'reviews_text_classified', sum(2 + CASE WHEN doc_id % 3 = 2 OR (doc_id % 3 = 0 AND doc_id % 2 = 0) THEN 1 ELSE 0 END)
  FROM documents WHERE text <> ''), (VALUES ('csv'), ('parquet')) AS t(copy)""",
)
def snk_enriched(spark, sf):
    reviews = base_reviews(spark, sf)
    docs, info = review_topics(spark, sf)
    # review_id is unique in this input, so any order keeps the same rows.
    paths = tables.write_enriched(
        conform.build_meta(reviews, "review_id"), reshape.text_classified(reviews, docs, info), scratch_path(spark, "enriched")
    )
    return _copies(spark, paths, "reviews_meta").unionByName(_copies(spark, paths, "reviews_text_classified"))


def _copies(spark, paths, kind):
    """Rows of the Parquet and of the CSV copy of a table, and of each those that the other lacks, values compared as text."""
    full = spark.read.parquet(paths[kind])
    as_text = lambda df, name: df.select(F.lit(name).alias("copy"), F.xxhash64(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in full.columns]).alias("row"))
    both = as_text(full, "parquet").unionByName(as_text(tables.read_csv(spark, paths[f"{kind}.csv"], full.schema), "csv"))
    per_row = both.groupBy("row").agg(F.count_if(F.col("copy") == "parquet").alias("parquet"), F.count_if(F.col("copy") == "csv").alias("csv"))
    sums = per_row.agg(
        F.sum("parquet").alias("n_parquet"), F.sum("csv").alias("n_csv"),
        F.sum(F.greatest(F.col("parquet") - F.col("csv"), F.lit(0))).alias("d_parquet"), F.sum(F.greatest(F.col("csv") - F.col("parquet"), F.lit(0))).alias("d_csv"),
    )
    return sums.selectExpr(f"'{kind}' AS kind", "stack(2, 'parquet', n_parquet, d_parquet, 'csv', n_csv, d_csv) AS (copy, n_rows, n_differing)")


@query(
    "snk_versioned",
    with_sql(
        i.V_LONG,
        query="""
SELECT t.run_version, text_field, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(topic_id) AS BIGINT) AS topic_sum
FROM v_long, (VALUES ('v1'), ('v2')) AS t(run_version) GROUP BY ALL""",
    ),
)
def snk_versioned(spark, sf):
    path = scratch_path(spark, "versioned")
    rows = i.reviews_long(spark, sf).select("review_id", "text_field", "topic_id")
    tables.write_versioned(rows.withColumn("topic_id", F.col("topic_id") + 1), path, "v1")
    tables.write_versioned(rows, path, "v2")
    tables.write_versioned(rows, path, "v1")  # replaces v1 only
    return spark.read.parquet(path).groupBy("run_version", "text_field").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("topic_id").alias("topic_sum")
    )


@query(
    "snk_audit",
    with_sql(
        i.V_LONG,
        i.V_MAP,
        query="""
SELECT 'v1' AS run_version, text_field, topic_id, concat('Topic ', CAST(topic_id AS VARCHAR), ' of ', text_field) AS plain_description,
  macro_group AS group_before, coalesce(macro_group, 'unassigned') AS group_after,
  CASE WHEN macro_group IS NULL THEN 'no group given' END AS reasoning
FROM (SELECT DISTINCT text_field, topic_id FROM v_long) LEFT JOIN v_map USING (topic_id)""",
    ),
)
def snk_audit(spark, sf):
    path = scratch_path(spark, "audit")
    topics = i.reviews_long(spark, sf).select("text_field", "topic_id").distinct().join(i.topic_map(spark), "topic_id", "left")
    grouping = topics.select(
        "text_field",
        "topic_id",
        F.concat(F.lit("Topic "), F.col("topic_id").cast("string"), F.lit(" of "), "text_field").alias("plain_description"),
        F.col("macro_group").alias("group_before"),
        F.coalesce("macro_group", F.lit("unassigned")).alias("group_after"),
        F.when(F.col("macro_group").isNull(), "no group given").alias("reasoning"),
    )
    tables.write_audit(grouping, path, "v1")
    topic = "topic_id: int, enrichment: struct<plain_description: string>, grouping: struct<before: string, after: string, reasoning: string>"
    return spark.read.schema(f"text_field string, topic struct<{topic}>, run_version string").json(path).select(
        "run_version", "text_field", "topic.topic_id", "topic.enrichment.plain_description", F.col("topic.grouping.before").alias("group_before"),
        F.col("topic.grouping.after").alias("group_after"), "topic.grouping.reasoning",
    )


@query("agg_run_summary", with_sql(RUN_LOG_SQL, query="""
SELECT actor_key, product_key, CAST(count(*) AS BIGINT) AS n_runs, CAST(sum(item_count) AS BIGINT) AS item_count,
       CAST(sum(CAST(round(duration_secs * 10) AS BIGINT)) AS DOUBLE) / 10 AS duration_secs
FROM v_log GROUP BY ROLLUP (actor_key, product_key)"""))
def agg_run_summary(spark, sf):
    from reviewlens.operators.marts import run_summary

    return run_summary(logged_runs(spark, sf))
