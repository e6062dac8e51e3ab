"""Vectors: embedding, reduction, neighbour graph, clustering, assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import clustering as cl
from reviewlens.operators import grouping as gr
from reviewlens.operators import marts
from reviewlens.operators import neighbour_map as nm
from reviewlens.operators import term_vectors as tv
from reviewlens.operators import topics as tp
from reviewlens.operators import vectors as ve
from reviewlens.plans import inputs as i
from reviewlens.plans.chain import pct
from reviewlens.plans.inputs import r, with_sql
from reviewlens.plans.registry import query
from reviewlens.session import scratch_path

PIVOTS, MIN_POINTS, CLOSENESS, MIN_LINK, MIN_SIZE = 64, 3, 0.75, 2, 10


def embeddings(spark, sf):
    return i.table(spark, sf, "embeddings")


# -- SQL steps ------------------------------------------------------------------------------

V_VEC = ("v_vec", "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")
V_PIVOT = (
    "v_pivot",
    f"""
SELECT vec_id AS cell, x AS p FROM (
  SELECT *, row_number() OVER (PARTITION BY x ORDER BY code, vec_id) AS copy FROM (
    SELECT *, md5(CAST(vec_id AS VARCHAR)) AS code FROM v_vec ORDER BY code, vec_id LIMIT {4 * PIVOTS}))
WHERE copy = 1 ORDER BY code, vec_id LIMIT {PIVOTS}""",
)
V_NEAR = (
    "v_near",
    """
SELECT vec_id, max(cell) FILTER (rn = 1) AS cell, max(d) FILTER (rn = 1) AS d1, max(cell) FILTER (rn = 2) AS cell2,
  max(d) FILTER (rn = 2) AS d2
FROM (SELECT vec_id, cell, list_distance(x, p) AS d,
    row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(x, p), cell) AS rn FROM v_vec, v_pivot) WHERE rn <= 2
GROUP BY vec_id""",
)
V_LINK = (
    "v_link",
    f"""
SELECT least(cell, cell2) AS cell_a, greatest(cell, cell2) AS cell_b, CAST(count(*) AS BIGINT) AS weight
FROM v_near WHERE d1 >= d2 * {CLOSENESS}::DOUBLE GROUP BY ALL""",
)
GRAPH = (V_VEC, V_PIVOT, V_NEAR, V_LINK)
V_CELL = ("v_cell", "SELECT cell, count(*) AS n FROM v_near GROUP BY cell")
V_STRONG = (
    "v_strong",
    f"""
SELECT l.* FROM v_link l JOIN v_cell a ON l.cell_a = a.cell JOIN v_cell b ON l.cell_b = b.cell
WHERE weight >= {MIN_LINK} AND 10 * weight >= least(a.n, b.n)""",
)
V_EDGE = ("v_edge", "SELECT cell_a AS a, cell_b AS b, weight FROM v_strong UNION ALL SELECT cell_b, cell_a, weight FROM v_strong")
V_DENSE = (
    "v_dense",
    f"SELECT cell FROM v_cell WHERE n >= {MIN_POINTS} AND 10 * n * (SELECT count(*) FROM v_cell) >= (SELECT sum(n) FROM v_cell)",
)
V_REACH = (
    "v_reach",
    f"""
SELECT cell, cell AS seen FROM v_dense
UNION
SELECT r.cell, e.b FROM v_reach r JOIN v_edge e ON r.seen = e.a JOIN v_dense c ON c.cell = e.b""",
)
V_CORE = ("v_core", "SELECT cell, min(seen) AS component FROM v_reach GROUP BY cell")
V_MEMBER = (
    "v_member",
    """
SELECT cell, component FROM v_core
UNION ALL
SELECT cell, component FROM (SELECT e.a AS cell, k.component, row_number() OVER (PARTITION BY e.a ORDER BY e.weight DESC, e.b) AS rn
  FROM v_edge e JOIN v_core k ON k.cell = e.b WHERE e.a NOT IN (SELECT cell FROM v_core)) WHERE rn = 1""",
)
V_NUMBER = (
    "v_number",
    f"""
SELECT component, CAST(row_number() OVER (ORDER BY size DESC, component) - 1 AS INTEGER) AS topic_id
FROM (SELECT component, sum(n) AS size FROM v_member JOIN v_cell USING (cell) GROUP BY component) WHERE size >= {MIN_SIZE}""",
)
CLUSTER_SQL = with_sql(
    *GRAPH, V_CELL, V_STRONG, V_EDGE, V_DENSE, V_REACH, V_CORE, V_MEMBER, V_NUMBER,
    query="""
SELECT v.vec_id, v.cell, coalesce(k.topic_id, -1) AS topic_id
FROM v_near v LEFT JOIN v_member m ON v.cell = m.cell LEFT JOIN v_number k ON m.component = k.component""",
).replace("WITH ", "WITH RECURSIVE ", 1)

DIMS = "(SELECT vec_id, label, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS d FROM {src})"


def centroid_sql(source: str, key: str) -> str:
    return f"""
SELECT {key}, list(m ORDER BY d) AS c FROM (SELECT {key}, d, avg(v) AS m FROM {DIMS.format(src=source)} GROUP BY {key}, d) GROUP BY {key}"""


# -- queries --------------------------------------------------------------------------------


KNN, KNN_EVERY = 5, 20


@query(
    "tm_knn",
    with_sql(
        V_VEC,
        ("v_pair", f"""
SELECT a.vec_id, b.vec_id AS neighbour, {r("list_distance(a.x, b.x)", 9)} AS distance
FROM v_vec a JOIN v_vec b ON a.vec_id <> b.vec_id WHERE a.vec_id % {KNN_EVERY} = 0"""),
        query=f"""
SELECT vec_id, neighbour, CAST(rn AS INTEGER) AS rank, {r("distance", 6)} AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rn FROM v_pair) WHERE rn <= {KNN}""",
    ),
)
def tm_knn(spark, sf):
    """Every row whose id is divisible by 20 asks all rows. The twin compares all pairs."""
    near = cl.neighbours(embeddings(spark, sf), "vec_id", KNN, queries=F.col("vec_id") % KNN_EVERY == 0)
    return near.withColumn("distance", round_half_up(F.col("distance"), 6))


@query("tm_cluster_density", CLUSTER_SQL)
def tm_cluster_density(spark, sf):
    return cl.density_clusters(
        embeddings(spark, sf), "vec_id", pivots=PIVOTS, min_points=MIN_POINTS, closeness=CLOSENESS, min_link=MIN_LINK,
        min_cluster_size=MIN_SIZE,
    )


# Fitted numbers have no twin in SQL; these queries return every key with properties that the result must have.


def squared_length(vec):
    return F.aggregate(vec, F.lit(0.0), lambda s, v: s + v * v)


# Lengths of all vectors around their common mean, which any split into topics must lower.
KMEANS_SQL = with_sql(
    V_VEC,
    ("v_mean", "SELECT d, avg(v) AS m FROM (SELECT unnest(x) AS v, unnest(range(1, len(x) + 1)) AS d FROM v_vec) GROUP BY d"),
    ("v_all", "SELECT sum((v - m) * (v - m)) AS whole FROM (SELECT unnest(x) AS v, unnest(range(1, len(x) + 1)) AS d FROM v_vec) JOIN v_mean USING (d)"),
    query=f"SELECT vec_id, label, true AS has_topic, 10::BIGINT AS n_topics, true AS is_tighter, {r('whole', 3)} AS spread FROM v_vec, v_all",
)


@query("tm_cluster_kmeans", KMEANS_SQL)
def tm_cluster_kmeans(spark, sf):
    """Topics must hold together: around their means the vectors spread less than 0.97 of what they do around the common
    mean, where topics dealt at random keep more than 0.99."""
    rows = cl.kmeans_topics(embeddings(spark, sf), 10)
    n = rows.select(F.countDistinct("topic_id").alias("n")).scalar()
    around = lambda keys: ve.mean_vectors(rows.withColumn("__all", F.lit(0)), keys).select(
        F.sum(F.col("n_vectors") * squared_length(F.col("centroid"))).alias("held")
    )
    lengths = rows.select(F.sum(squared_length(F.col("embedding").cast("array<double>"))).alias("s")).scalar()
    within, whole = lengths - around(["topic_id"]).scalar(), lengths - around(["__all"]).scalar()
    return rows.select(
        "vec_id", "label", F.col("topic_id").between(0, 9).alias("has_topic"), n.alias("n_topics"),
        (within < 0.97 * whole).alias("is_tighter"), round_half_up(whole, 3).alias("spread"),
    )


def length_of(vec):
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, v: s + v * v))


@query("tm_embed", "SELECT doc_id, 64 AS n_dims, true AS is_unit, true AS languages_apart FROM documents")
def tm_embed(spark, sf):
    """Vectors of unit length, or zero for a text without terms. Languages share few words, so around the means of their
    languages the vectors must spread clearly less than around the common mean; vectors at random would spread as much."""
    docs = i.table(spark, sf, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "document-vectors")
    tv.embed(docs, tv.fit(docs, tp.DEFAULT_STOP, dim=64)).drop("text").write.parquet(path)
    rows = spark.read.parquet(path)
    size = length_of(F.col("embedding"))
    around = lambda keys: ve.mean_vectors(rows.withColumn("__all", F.lit(0)), keys).select(
        F.sum(F.col("n_vectors") * squared_length(F.col("centroid"))).alias("held")
    ).scalar()
    lengths = rows.select(F.sum(squared_length(F.col("embedding").cast("array<double>"))).alias("s")).scalar()
    apart = lengths - around(["lang"]) < 0.8 * (lengths - around(["__all"]))
    return rows.select("doc_id", F.size("embedding").alias("n_dims"), ((size == 0) | (F.abs(size - 1) < 1e-5)).alias("is_unit"), apart.alias("languages_apart"))


@query("tm_reduce", "SELECT vec_id, label, 10 AS n_dims, true AS within_unit, true AS holds_variance, true AS uncorrelated FROM embeddings")
def tm_reduce(spark, sf):
    """A projection of a unit vector is no longer than the vector. The ten components of largest variance hold more of it than
    any ten of the given dimensions, in falling order, and are uncorrelated."""
    rows = ve.reduce_dims(embeddings(spark, sf), 10)
    at = lambda c, k: F.element_at(F.col(c), k + 1)
    stats = rows.select(
        *[F.var_pop(at("reduced", k)).alias(f"v{k}") for k in range(10)],
        F.sort_array(F.array(*[F.var_pop(at("embedding", k)) for k in range(64)]), asc=False).alias("given"),
        F.greatest(*[F.abs(F.covar_pop(at("reduced", a), at("reduced", b))) for a in range(10) for b in range(a)]).alias("worst"),
    ).first()  # one row
    found = [stats[f"v{k}"] for k in range(10)]
    holds = sum(found) > sum(stats.given[:10]) and all(a >= b - 1e-9 for a, b in zip(found, found[1:]))
    return rows.select(
        "vec_id", "label", F.size("reduced").alias("n_dims"), (length_of(F.col("reduced")) <= 1 + 1e-6).alias("within_unit"),
        F.lit(holds).alias("holds_variance"), F.lit(stats.worst < 1e-6).alias("uncorrelated"),
    )


@query("tm_reduce_neighbours", "SELECT vec_id, label, 10 AS n_dims, true AS is_finite, true AS keeps_more FROM embeddings")
def tm_reduce_neighbours(spark, sf):
    """Of the 15 nearest rows of every row whose id is divisible by 20, more stay among the 15 nearest than under as many
    principal components."""
    path = scratch_path(spark, "neighbour-map")
    mapped = nm.reduce_by_neighbours(embeddings(spark, sf), "vec_id", 10).withColumnRenamed("reduced", "mapped")
    unit = F.transform("embedding", lambda v: v / length_of(F.col("embedding")))
    ve.reduce_dims(mapped, 10).withColumn("unit", unit).write.parquet(path)
    rows = spark.read.parquet(path)
    kept = lambda vec: nm.kept_neighbours(rows, "vec_id", "unit", vec, 15, F.col("vec_id") % KNN_EVERY == 0).scalar()
    finite = F.forall("mapped", lambda v: F.abs(v) < float("inf"))
    return rows.select("vec_id", "label", F.size("mapped").alias("n_dims"), finite.alias("is_finite"), (kept("mapped") > kept("reduced")).alias("keeps_more"))


V_CENT = ("v_cent", centroid_sql("v_vec", "label"))


@query(
    "tm_soft_prob",
    with_sql(
        V_VEC, V_CENT,
        query=f"""
SELECT vec_id, arg_min(label, (-s, label)) AS best_topic, {r("max(exp(s)) / sum(exp(s))", 4)} AS probability
FROM (SELECT v.vec_id, c.label, list_cosine_similarity(v.x, c.c) AS s FROM v_vec v, v_cent c) GROUP BY vec_id""",
    ),
)
def tm_soft_prob(spark, sf):
    vectors = embeddings(spark, sf).withColumnRenamed("label", "topic_id")
    scored = ve.soft_probability(vectors, ve.mean_vectors(vectors, ["topic_id"]))
    return scored.select("vec_id", "best_topic", round_half_up(F.col("probability"), 4).alias("probability"))


# A third of the documents start out as noise.
V_NOISY = ("v_noisy", "SELECT vec_id, x, CASE WHEN vec_id % 3 = 0 THEN -1 ELSE label END AS label FROM v_vec")
V_MOVED = (
    "v_moved",
    """
SELECT n.vec_id, n.label AS topic_before, CASE WHEN n.label = -1 THEN m.best ELSE n.label END AS topic_id
FROM v_noisy n LEFT JOIN (SELECT vec_id, arg_min(label, (-s, label)) AS best FROM (
  SELECT v.vec_id, c.label, list_cosine_similarity(v.x, c.c) AS s FROM v_noisy v, v_kept c WHERE v.label = -1) GROUP BY vec_id) m
USING (vec_id)""",
)
NOISY = (V_VEC, V_NOISY, ("v_settled", "SELECT * FROM v_noisy WHERE label <> -1"), ("v_kept", centroid_sql("v_settled", "label")), V_MOVED)


def moved(spark, sf):
    noisy = embeddings(spark, sf).withColumn(
        "topic_id", F.when(F.col("vec_id") % 3 == 0, -1).otherwise(F.col("label")).cast("int")
    )
    return ve.reassign_outliers(noisy.drop("label"))


@query("tm_reassign_outliers", with_sql(*NOISY, query="SELECT *, topic_before = -1 AS was_outlier FROM v_moved"))
def tm_reassign_outliers(spark, sf):
    return moved(spark, sf).select("vec_id", "topic_before", "topic_id", "was_outlier")


@query(
    "agg_outlier_rate",
    with_sql(
        *NOISY,
        query=f"""
SELECT concat('field', CAST(vec_id % 2 AS VARCHAR)) AS text_field, CAST(count(*) AS BIGINT) AS total_docs,
  CAST(count(*) FILTER (topic_before = -1) AS BIGINT) AS outliers_before,
  {pct("count(*) FILTER (topic_before = -1)", "count(*)")} AS outlier_pct_before,
  CAST(count(*) FILTER (topic_id = -1) AS BIGINT) AS outliers_after, {pct("count(*) FILTER (topic_id = -1)", "count(*)")} AS outlier_pct_after
FROM v_moved GROUP BY 1""",
    ),
)
def agg_outlier_rate(spark, sf):
    field = F.concat(F.lit("field"), (F.col("vec_id") % 2).cast("string"))
    return marts.outlier_rate(moved(spark, sf).withColumn("text_field", field))


FINE_TOPICS = "SELECT DISTINCT CAST(label * 4 + vec_id % 4 AS INTEGER) AS topic_id FROM embeddings"
MERGED = 10
# One step of the rule a row: the topics left, each with the topics that it has taken.
MERGE_SQL = f"""
WITH RECURSIVE v_fine AS (SELECT CAST(label * 4 + vec_id % 4 AS INTEGER) AS topic_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
v_mean AS (SELECT topic_id, list(m ORDER BY d) AS v FROM (SELECT topic_id, d, avg(u) AS m FROM (
  SELECT topic_id, unnest(x) AS u, unnest(range(1, len(x) + 1)) AS d FROM v_fine) GROUP BY topic_id, d) GROUP BY topic_id),
v_topic AS (SELECT topic_id, v, (SELECT count(*) FROM v_fine f WHERE f.topic_id = m.topic_id)::DOUBLE AS size FROM v_mean m),
v_step AS (
  SELECT 0 AS step, list({{'id': topic_id, 'size': size, 'v': v, 'has': [topic_id]}} ORDER BY topic_id) AS topics FROM v_topic
  UNION ALL
  SELECT step + 1, list_transform(others, lambda x: CASE WHEN x.id = list_min(near).id
      THEN {{'id': x.id, 'size': x.size + small.size, 'v': list_transform(list_zip(x.v, small.v), lambda p: (p[1] * x.size + p[2] * small.size) / (x.size + small.size)),
             'has': x.has || small.has}} ELSE x END)
  FROM (SELECT step, small, others, list_transform(others, lambda x: {{'s': -floor(list_cosine_similarity(x.v, small.v) * 1e12::DOUBLE + 0.5::DOUBLE), 'id': x.id}}) AS near
    FROM (SELECT step, small, list_filter(topics, lambda x: x.id <> small.id) AS others
      FROM (SELECT step, topics, list_filter(topics, lambda x: x.id = -first_.minus)[1] AS small
        FROM (SELECT step, topics, list_min(list_transform(topics, lambda x: {{'size': x.size, 'minus': -x.id}})) AS first_ FROM v_step WHERE len(topics) > {MERGED})))))
SELECT CAST(unnest(t.has) AS INTEGER) AS topic_id, CAST(t.id AS INTEGER) AS merged_topic
FROM (SELECT unnest(topics) AS t FROM v_step WHERE step = (SELECT max(step) FROM v_step))"""


@query("tm_merge_topics", MERGE_SQL)
def tm_merge_topics(spark, sf):
    vectors = embeddings(spark, sf).withColumn("topic_id", (F.col("label") * 4 + F.col("vec_id") % 4).cast("int"))
    return ve.merge_topics(ve.mean_vectors(vectors, ["topic_id"]), MERGED)


def long_topics(spark, sf):
    """Every document, with the topic that the long table gives it (-1 is a topic of its own here)."""
    return i.reviews_long(spark, sf).select(F.col("review_id").cast("bigint").alias("doc_id"), "text", "topic_id")


def fine_topics(spark, sf):
    """Every document, dealt over as many topics as the given vectors have fine ones."""
    return i.table(spark, sf, "documents").select("doc_id", "text", F.pmod("doc_id", F.lit(40)).cast("int").alias("topic_id"))


def topic_docs(docs):
    """Documents with their vectors."""
    return ve.embed(docs, ve.fit_embedding(docs, tp.DEFAULT_STOP, dim=64), tp.DEFAULT_STOP).select("doc_id", "text", "embedding", "topic_id")


def topic_keywords(docs):
    return tp.top_terms(tp.ctfidf(docs, ["topic_id"]), ["topic_id"], 20)


KEYPHRASE_DIM = 256


def _bucket_steps(terms: str, dim: int) -> list[tuple[str, str]]:
    """Steps from a table of different terms to h_bucket (term, bucket): Murmur3 of the UTF-8 bytes with seed 42, as HashingTF has it."""
    word = "4294967296::UBIGINT"
    times = lambda x, by: f"(({x}) * {by}::UBIGINT) % {word}"
    turned = lambda x, n: f"((({x}) << {n}) % {word} + (({x}) >> {32 - n}))"
    return [
        ("h_hex", f"SELECT term, hex(term) AS h, length(hex(term)) // 2 AS size FROM {terms}"),
        ("h_part", "SELECT term, size, list_transform(range(0, (size + 3) // 4), lambda i: "
                   "('0x' || h[8 * i + 7:8 * i + 8] || h[8 * i + 5:8 * i + 6] || h[8 * i + 3:8 * i + 4] || h[8 * i + 1:8 * i + 2])::UBIGINT) AS k FROM h_hex"),
        ("h_mixed", f"SELECT term, size, list_transform(list_transform(k, lambda k: {times('k', 0xCC9E2D51)}), "
                    f"lambda k: {times(turned('k', 15), 0x1B873593)}) AS k FROM h_part"),
        ("h_sum", f"SELECT term, xor(xor(list_reduce(k[:size // 4], lambda h, k: ({turned('xor(h, k)', 13)} * 5::UBIGINT + {0xE6546B64}::UBIGINT) % {word}, "
                  "42::UBIGINT), coalesce(k[size // 4 + 1], 0::UBIGINT)), size::UBIGINT) AS h FROM h_mixed"),
        ("h_once", f"SELECT term, {times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM h_sum"),
        ("h_twice", f"SELECT term, {times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM h_once"),
        ("h_bucket", f"SELECT term, CAST(xor(h, h >> 16) % {dim}::UBIGINT AS INTEGER) AS bucket FROM h_twice"),
    ]


V_TD = ("v_td", "SELECT CAST(review_id AS BIGINT) AS doc_id, text, topic_id AS label FROM v_long")


def _keyphrase_sql() -> str:
    from reviewlens.plans import topic_queries as tq

    stop = tq._STOP
    return with_sql(
        i.V_LONG, V_TD,
        ("v_kept", rf"""SELECT doc_id, label, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
  lambda w: w NOT IN ({stop})) AS kept FROM v_td"""),
        ("v_uses", "SELECT doc_id, label, unnest(kept || list_transform(kept[2:], lambda w, n: kept[n] || ' ' || w)) AS term FROM v_kept"),
        ("v_cnt", "SELECT label, term, count(*) AS n FROM v_uses GROUP BY ALL"),
        ("v_voc", "SELECT term, sum(n) AS f FROM v_cnt GROUP BY term HAVING count(*) >= 5 AND count(*) <= "
                  "(SELECT count(DISTINCT label) FROM v_cnt) * 0.85::DOUBLE"),
        ("v_tot", "SELECT label, sum(n) AS total FROM v_cnt JOIN v_voc USING (term) GROUP BY label"),
        ("v_wt", "SELECT c.label, c.term, sqrt(c.n / t.total::DOUBLE) * ln(1.0::DOUBLE + (SELECT floor(avg(total)) FROM v_tot) / v.f::DOUBLE) "
                 "AS w FROM v_cnt c JOIN v_voc v USING (term) JOIN v_tot t USING (label)"),
        ("v_cand", "SELECT label, term FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY floor(w * 1e9::DOUBLE + 0.5::DOUBLE) DESC, "
                   "term) AS rn FROM v_wt) WHERE rn <= 20"),
        # Hashed TF-IDF at unit length, one row for each bucket that a document has.
        ("v_term", "SELECT DISTINCT term FROM v_cnt"),
        *_bucket_steps("v_term", KEYPHRASE_DIM),
        ("v_tf", "SELECT doc_id, label, bucket, count(*) AS tf FROM v_uses JOIN h_bucket USING (term) GROUP BY ALL"),
        ("v_idf", "SELECT bucket, ln(((SELECT count(*) FROM v_td) + 1)::DOUBLE / (count(*) + 1)::DOUBLE) AS idf FROM v_tf GROUP BY bucket"),
        ("v_raw", "SELECT doc_id, label, bucket, tf * idf AS v FROM v_tf JOIN v_idf USING (bucket)"),
        ("v_norm", "SELECT doc_id, sqrt(sum(v * v)) AS size FROM v_raw GROUP BY doc_id"),
        ("v_x", "SELECT doc_id, label, bucket, CAST(CAST(CASE WHEN size > 0 THEN v / size ELSE 0 END AS FLOAT) AS DOUBLE) AS v FROM v_raw JOIN v_norm USING (doc_id)"),
        ("v_size", "SELECT label, count(*) AS docs FROM v_td GROUP BY label"),
        ("v_dc", "SELECT label, bucket, sum(v) / any_value(docs) AS c FROM v_x JOIN v_size USING (label) GROUP BY label, bucket"),
        ("v_pick", "SELECT DISTINCT u.doc_id, u.label, u.term FROM v_uses u JOIN v_cand USING (label, term)"),
        ("v_pair", "SELECT label, term, count(*) AS docs FROM v_pick GROUP BY ALL"),
        ("v_tv", "SELECT p.label, p.term, x.bucket, sum(x.v) / any_value(q.docs) AS t FROM v_pick p JOIN v_x x USING (doc_id) "
                 "JOIN v_pair q ON q.label = p.label AND q.term = p.term GROUP BY ALL"),
        ("v_len", "SELECT label, sum(c * c) AS cc FROM v_dc GROUP BY label"),
        ("v_cos", "SELECT label, term, CASE WHEN sum(t * t) * any_value(cc) = 0 THEN 0 ELSE sum(t * c) / sqrt(sum(t * t) * any_value(cc)) END AS s "
                  "FROM v_tv JOIN v_dc USING (label, bucket) JOIN v_len USING (label) GROUP BY label, term"),
        query=f"""
SELECT label AS topic_id, term, {r("s", 4)} AS similarity, CAST(rn AS INTEGER) AS term_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY floor(s * 1e9::DOUBLE + 0.5::DOUBLE) DESC, term) AS rn FROM v_cos) WHERE rn <= 10""",
        once=("v_td", "v_uses", "v_cnt", "v_voc", "v_cand", "v_x", "v_pick"),
    )


@query("tm_keyphrase", _keyphrase_sql())
def tm_keyphrase(spark, sf):
    """Over all documents, with the vectors of the default encoder."""
    docs = long_topics(spark, sf)
    candidates = topic_keywords(docs).checkpoint()  # 20 terms a topic
    encoded = ve.encode_with_candidates(docs, candidates, tp.DEFAULT_STOP, KEYPHRASE_DIM)
    ranked = ve.keyphrases(encoded, candidates, tp.DEFAULT_STOP)
    return ranked.withColumn("similarity", round_half_up(F.col("similarity"), 4))


@query("gr_by_similarity", f"SELECT topic_id, true AS has_group, true AS has_label FROM ({FINE_TOPICS})")
def gr_by_similarity(spark, sf):
    docs = fine_topics(spark, sf)
    centroids = ve.mean_vectors(topic_docs(docs), ["topic_id"])
    keywords = tp.clean_keywords(topic_keywords(docs), ["topic_id"])
    groups = gr.group_by_similarity(centroids, keywords)
    return groups.select("topic_id", F.rlike("macro_group", F.lit("^group_[0-9]$")).alias("has_group"), (F.length("group_label") > 0).alias("has_label"))


@query("tm_model_io", "SELECT doc_id, true AS has_topic, true AS same_as_unsaved FROM documents")
def tm_model_io(spark, sf):
    """Save encoder, centroids and term weights, load them again, and assign every document with both."""
    from reviewlens.operators import model_io

    path = scratch_path(spark, "topic-model")
    # Every document, with the topic that the long table gives it.
    docs = i.reviews_long(spark, sf).select(F.col("review_id").cast("bigint").alias("doc_id"), "text", "topic_id").filter("topic_id <> -1")
    encoder = ve.fit_embedding(docs, tp.DEFAULT_STOP, dim=64)
    encoded = ve.embed(docs, encoder, tp.DEFAULT_STOP)
    weights = tp.ctfidf(docs, ["topic_id"])
    centroids, settings = ve.mean_vectors(encoded, ["topic_id"]), {"min_topic_size": 10, "max_topics": 60}
    model_io.save(path, encoder, centroids, weights, settings)
    loaded = model_io.load(spark, path)
    every = i.table(spark, sf, "documents").select("doc_id", "text")
    saved = model_io.assign(every, loaded, tp.DEFAULT_STOP).select("doc_id", "topic_id", "probability")
    # The centroids as they are in memory, so that a damaged table does not go unnoticed.
    unsaved = model_io.assign(every, model_io.TopicModel(encoder, centroids.checkpoint(), weights, settings), tp.DEFAULT_STOP)
    both = saved.join(unsaved.select("doc_id", F.col("topic_id").alias("t"), F.col("probability").alias("p")), "doc_id")
    same = (F.col("topic_id") == F.col("t")) & (F.col("probability") == F.col("p"))
    return both.select("doc_id", F.col("topic_id").isNotNull().alias("has_topic"), same.alias("same_as_unsaved"))


def _stage_sql() -> str:
    from reviewlens import config as cfg
    from reviewlens.plans import text_queries as tq

    return with_sql(
        i.V_LONG,
        ("v_flat", r"SELECT review_id, text_field, trim(regexp_replace(regexp_replace(text, '\\r\\n|\\n|\\r', ' ', 'g'), '\s+', ' ', 'g')) AS c FROM v_long"),
        ("v_kept", rf"""SELECT review_id, text_field, CASE WHEN text_field = 'use_case' THEN regexp_replace(c, '{tq.LEAK}', '.') ELSE c END AS c
  FROM v_flat WHERE c NOT IN ('nan', 'None', '')"""),
        ("v_full", f"SELECT review_id, text_field, {tq.expand_sql('c')} AS e FROM v_kept"),
        query=f"""
SELECT review_id, text_field, sha256(e) AS text_hash, true AS has_topic, true AS is_counted FROM v_full WHERE length(e) >= {cfg.MIN_CHARS}""",
    )


@query("tm_stage", _stage_sql())
def tm_stage(spark, sf):
    """Every usable text of every field with its topic; topics differ between engines, so properties are compared: a document
    has a topic with a probability or is an outlier without one, and its topic's refreshed count is that of its documents."""
    from reviewlens.operators import topic_stage

    found = topic_stage.run(i.reviews_long(spark, sf), settings={f: {"pivots": PIVOTS, "max_topics": 20} for f in ("likes", "dislikes", "use_case")})
    keys = ["text_field", "topic_id"]
    counted = found.documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(found.info.select(*keys, "doc_count"), keys, "left")
    right = counted.select(*keys, F.coalesce(F.col("n") == F.col("doc_count"), F.lit(False)).alias("is_counted"))
    outlier = F.col("topic_id") == -1
    has_topic = F.when(outlier, F.col("probability").isNull()).otherwise(F.coalesce(F.col("probability").between(0, 1), F.lit(False)))
    # One row for each topic.
    return found.documents.join(F.broadcast(right), keys).select("review_id", "text_field", F.sha2("text", 256).alias("text_hash"), has_topic.alias("has_topic"), "is_counted")
