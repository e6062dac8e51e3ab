"""Document vectors: embedding, reduction, centroids and nearest-centroid work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, HashingTF, IDF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.dedup import keep_top
from reviewlens.operators.lookup import join_small
from reviewlens.operators.topics import with_terms
from reviewlens.session import ensure_checkpoint_dir, scratch_path

# Centroid tables up to this many rows travel to the tasks as one matrix; larger ones go in blocks of this size.
CENTROID_BLOCK = 4096

# -- embedding ----------------------------------------------------------------------

Embedder = Callable[[pd.Series], np.ndarray]


def _hashed(dim: int) -> HashingTF:
    return HashingTF(inputCol="__terms", outputCol="__tf", numFeatures=dim)


def _weighing() -> list:
    return [IDF(inputCol="__tf", outputCol="__idf"), Normalizer(inputCol="__idf", outputCol="__vec")]


def _encoder_terms(docs: DataFrame, stop: list[str]) -> DataFrame:
    """Add ``__terms``; a null text has none."""
    return with_terms(docs, stop, "__terms").withColumn("__terms", F.coalesce("__terms", F.array().cast("array<string>")))


def fit_embedding(docs: DataFrame, stop: list[str], dim: int = 256, text: str = "text") -> PipelineModel:
    """The default document encoder: hashed terms, inverse document frequency, unit length. No vocabulary is kept."""
    stages = [_hashed(dim), *_weighing()]
    return Pipeline(stages=stages).fit(_encoder_terms(docs.select(F.col(text).alias("text")), stop).select("__terms"))


def embed(docs: DataFrame, model: PipelineModel, stop: list[str], text: str = "text") -> DataFrame:
    """Add ``embedding`` with a fitted default encoder."""
    encoded = model.transform(_encoder_terms(docs.withColumn("text", F.col(text)), stop))
    return encoded.withColumn("embedding", vector_to_array("__vec", "float32")).drop("__terms", "__tf", "__idf", "__vec")


def embed_with(docs: DataFrame, factory: Callable[[], Embedder], key: str, text: str = "text", batch: int = 256) -> DataFrame:
    """Vectors from a plugged-in encoder: ``factory`` loads it once per task, then it takes batches of texts."""
    schema = T.StructType([docs.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType(), False))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = factory()
        for pdf in frames:
            for start in range(0, len(pdf), batch):
                part = pdf.iloc[start : start + batch]
                matrix = np.asarray(encoder(part[text]), "float32")
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(matrix)})

    return docs.select(key, text).mapInPandas(run, schema)


def reduce_dims(df: DataFrame, k: int = 10, vec: str = "embedding") -> DataFrame:
    """``k``-dimensional ``reduced`` by principal components of the unit vectors (so Euclidean distance follows cosine)."""
    unit = Normalizer(inputCol="__vec", outputCol="__unit").transform(df.withColumn("__vec", array_to_vector(vec)))
    model = PCA(k=k, inputCol="__unit", outputCol="__pca").fit(unit)
    return model.transform(unit).withColumn("reduced", vector_to_array("__pca")).drop("__vec", "__unit", "__pca")


# -- centroids ------------------------------------------------------------------------


def mean_vectors(df: DataFrame, keys: list[str], vec: str = "embedding", out: str = "centroid") -> DataFrame:
    """Mean vector and row count per key. Each task adds up its rows first, so a key with most rows costs one vector."""
    return df.groupBy(*keys).agg(
        vector_to_array(Summarizer.mean(array_to_vector(vec))).alias(out), F.count(F.lit(1)).alias("n_vectors")
    )


def _blocks(centroids: DataFrame, cid: str, cvec: str, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Centroids as (ids, matrix), in one piece when there are at most ``block``, else piece by piece."""
    ensure_checkpoint_dir(centroids.sparkSession)
    slim = centroids.select(F.col(cid).cast("bigint").alias("id"), F.col(cvec).cast("array<double>").alias("vec")).checkpoint()
    pieces = max(1, -(-slim.count() // block))
    for p in range(pieces):
        part = slim if pieces == 1 else slim.filter(F.pmod(F.xxhash64("id"), F.lit(pieces)) == p)
        rows = sorted(part.collect(), key=lambda row: row.id)
        if rows:
            yield np.array([r.id for r in rows]), np.array([r.vec for r in rows], "float64")


_SCAN = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
        T.StructField("exp_sum", T.DoubleType()),
    ]
)


def _scan(ids: np.ndarray, matrix: np.ndarray, k: int, metric: str):
    """Batch scorer against one centroid block: the ``k`` best ids, their scores, and the sum of exp(score)."""
    if metric == "cosine":
        matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    squares = (matrix**2).sum(axis=1)

    def score(vectors: pd.Series) -> pd.DataFrame:
        # Slices bound the score matrix; rows without a vector get no centroid.
        out_ids, out_scores, sums = [None] * len(vectors), [None] * len(vectors), np.full(len(vectors), np.nan)
        there = np.flatnonzero(vectors.notna().to_numpy())
        for start in range(0, len(there), 1000):
            rows = there[start : start + 1000]
            x = np.stack(vectors.iloc[rows].to_numpy()).astype("float64")
            if metric == "cosine":
                s = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)) @ matrix.T
            else:
                s = -np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] - 2 * (x @ matrix.T) + squares[None, :], 0.0))
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]
            for r, i, v in zip(rows, ids[best], np.take_along_axis(s, best, axis=1)):
                out_ids[r], out_scores[r] = i, v
            sums[rows] = np.exp(s).sum(axis=1)
        return pd.DataFrame({"ids": out_ids, "scores": out_scores, "exp_sum": sums})

    return F.pandas_udf(score, _SCAN)


def nearest(
    df: DataFrame,
    centroids: DataFrame,
    cid: str,
    cvec: str = "centroid",
    vec: str = "embedding",
    k: int = 1,
    metric: str = "cosine",
    block: int = CENTROID_BLOCK,
    empty_ok: bool = False,
) -> DataFrame:
    """Add ``near`` (the ``k`` best centroids as {score, id}, best first, ties to the lower id) and ``exp_sum``.

    Score is cosine similarity, or minus the Euclidean distance. Rows are never moved; each batch is one matrix product.
    ``near`` is null for rows without a vector and, with ``empty_ok``, where there are no centroids.
    """
    out = None
    for ids, matrix in _blocks(centroids, cid, cvec, block):
        df = df.withColumn("__scan", _scan(ids, matrix, k, metric)(F.col(vec)))
        found = F.zip_with("__scan.scores", "__scan.ids", lambda s, i: F.struct(s.alias("score"), i.alias("id")))
        total = F.col("__scan.exp_sum")
        if out is None:
            df = df.withColumns({"near": found, "exp_sum": total}).drop("__scan")
        else:
            order = lambda a, b: (
                F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["id"] < b["id"], -1).otherwise(1)
            )
            both = F.slice(F.array_sort(F.concat("near", found), order), 1, k)
            df = df.withColumns({"near": both, "exp_sum": F.col("exp_sum") + total}).drop("__scan")
        out = df
    if out is None:
        if not empty_ok:
            raise ValueError("no centroids")
        none = F.lit(None).cast("array<struct<score:double,id:bigint>>")
        return df.withColumns({"near": none, "exp_sum": F.lit(None).cast("double")})
    return out


def soft_probability(df: DataFrame, centroids: DataFrame, cid: str = "topic_id", **kw) -> DataFrame:
    """Best topic and its softmax probability over cosine similarity to all centroids."""
    scored = nearest(df, centroids, cid, k=1, **kw)
    top = F.col("near")[0]
    return scored.withColumns(
        {"best_topic": top["id"].cast("int"), "probability": F.exp(top["score"]) / F.col("exp_sum")}
    ).drop("near", "exp_sum")


def reassign_outliers(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Move outlier documents to the topic with the nearest centroid; ``topic_before`` keeps the old id.

    Every row comes out once: rows without a topic keep none, outliers without a vector stay outliers, and where there is no
    other topic nothing moves.
    """
    df = df.withColumn("topic_before", F.col("topic_id"))
    centroids = mean_vectors(df.filter(F.col("topic_id").isNotNull() & (F.col("topic_id") != -1) & F.col(vec).isNotNull()), ["topic_id"], vec)
    # Only outliers have a vector to look up, so other rows cost nothing in the scan.
    asked = df.withColumn("__asked", F.when(F.col("topic_id") == -1, F.col(vec)))
    found = nearest(asked, centroids, "topic_id", vec="__asked", empty_ok=True)
    best = F.get("near", F.lit(0))["id"].cast("int")
    moved = found.withColumn("topic_id", F.when(F.col("topic_id") == -1, F.coalesce(best, F.lit(-1))).otherwise(F.col("topic_id")))
    return moved.drop("near", "exp_sum", "__asked").withColumn("was_outlier", F.coalesce(F.col("topic_before") == -1, F.lit(False)))


#: Topics that may be merged in one round over all fields together; their vectors pass through the driver.
MERGE_BATCH = 4096


def _similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine similarities in units of 10^-12, so that ties are ties on every path."""
    unit = [x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) for x in (a, b)]
    return np.floor(unit[0] @ unit[1].T * 1e12 + 0.5)


def _settled(movers: list, targets: dict) -> list[tuple]:
    """The first merges of one field's round that the sequential rule makes too: (small topic, target, new vector, new size).

    Movers come smallest first. One is not settled if a merge before it has taken or changed it or its target, or has made a
    topic that it is closer to; the round ends there. The first mover always is.
    """
    out, touched, changed = [], set(), []
    for m in movers:
        t = targets[m.topic_id]
        if m.topic_id in touched or t.id in touched:
            break
        if changed:
            new = _similarity(np.array([m.vec]), np.array([v for _, v in changed]))[0]
            if any(s > t.similarity or (s == t.similarity and c < t.id) for s, (c, _) in zip(new, changed)):
                break
        size = t.size + m.size
        vec = (np.array(t.vec) * t.size + np.array(m.vec) * m.size) / size
        out.append((m.topic_id, t.id, [float(x) for x in vec], float(size)))
        touched |= {m.topic_id, t.id}
        changed.append((t.id, vec))
    return out


def merge_topics(centroids: DataFrame, max_topics: int, keys: list[str] | None = None, limit: int | None = None, batch: int = MERGE_BATCH) -> DataFrame:
    """topic_id -> merged_topic: the smallest topic joins its most similar one until ``max_topics`` are left in every field.

    Works on the centroid table (topic_id, centroid, n_vectors). Of equal sizes the highest id goes first, equal similarities
    go to the lowest id. In each round up to ``batch`` of the smallest topics look for their nearest in one scan over all
    centroids, and those merges are made that the sequential rule would make one after the other; so the result is the same,
    and no field has to fit one task. ``limit`` lets a caller refuse fields with more topics.
    """
    spark, keys = centroids.sparkSession, keys or []
    ensure_checkpoint_dir(spark)
    if limit is not None:
        largest = centroids.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if largest and largest > limit:
            raise ValueError(f"{largest} topics to merge; raise the minimum topic size")
    field = F.to_json(F.struct(*keys, F.lit(0).alias("__"))) if keys else F.lit("")
    state = centroids.select(
        *keys, field.alias("__field"), F.col("topic_id").cast("int").alias("topic_id"), F.col("topic_id").cast("int").alias("merged_topic"),
        F.col("centroid").cast("array<double>").alias("__vec"), F.col("n_vectors").cast("double").alias("__size"),
    ).checkpoint()
    found_type = "m int, best struct<similarity:double,minus:int,size:double,vec:array<double>>"
    merge_type = "__field string, __small int, __into int, __new_vec array<double>, __new_size double"
    while True:
        alive = state.filter(F.col("__vec").isNotNull())
        open_fields = alive.groupBy("__field").agg((F.count(F.lit(1)) - max_topics).alias("__over")).filter("__over > 0")
        chosen = open_fields.orderBy("__field").limit(batch).collect()  # a field a row, ``batch`` at most
        if not chosen:
            return state.select(*keys, "topic_id", "merged_topic")
        each = max(1, batch // len(chosen))
        over = F.broadcast(spark.createDataFrame([(r["__field"], min(r["__over"], each)) for r in chosen], "__field string, __take long"))
        smallest = keep_top(alive, ["__field"], [F.col("__size"), F.col("topic_id").desc()], each, "__rank")
        movers = smallest.join(over, "__field").filter("__rank <= __take").select("__field", "__rank", "topic_id", F.col("__vec").alias("vec"), F.col("__size").alias("size")).collect()
        movers.sort(key=lambda r: (r["__field"], r["__rank"]))
        of_field: dict[str, list[int]] = {}
        for n, r in enumerate(movers):
            of_field.setdefault(r["__field"], []).append(n)
        matrix, own = np.array([r.vec for r in movers], "float64"), np.array([r.topic_id for r in movers])

        def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[int, tuple] = {}
            for pdf in frames:
                for name, part in pdf.groupby("__field"):
                    asking = of_field.get(name, [])
                    if not asking:
                        continue
                    part = part.sort_values("topic_id")
                    ids, x = part["topic_id"].to_numpy(), np.stack(part["__vec"].to_numpy()).astype("float64")
                    s = _similarity(matrix[asking], x)
                    s[own[asking][:, None] == ids[None, :]] = -np.inf
                    for at, (m, c) in enumerate(zip(asking, s.argmax(axis=1))):
                        key = (s[at, c], -int(ids[c]))
                        if key[0] > -np.inf and (m not in best or key > best[m][:2]):
                            best[m] = (*key, float(part["__size"].iloc[c]), x[c].tolist())
            rows = [(m, dict(zip(("similarity", "minus", "size", "vec"), b))) for m, b in best.items()]
            yield pd.DataFrame(rows, columns=["m", "best"])

        reached = alive.select("__field", "topic_id", "__vec", "__size").mapInPandas(scan, found_type).groupBy("m").agg(F.max("best").alias("best"))
        nearest_of = {r.m: Row(id=-r.best.minus, similarity=r.best.similarity, size=r.best["size"], vec=r.best.vec) for r in reached.collect()}
        merges = []
        for name, asking in of_field.items():
            targets = {movers[n].topic_id: nearest_of[n] for n in asking}
            merges += [(name, *m) for m in _settled([movers[n] for n in asking], targets)]
        made = spark.createDataFrame(merges, merge_type)
        gone = F.broadcast(made.select("__field", F.col("__small").alias("merged_topic"), F.col("__into").alias("__to")))
        grown = F.broadcast(made.select("__field", F.col("__into").alias("topic_id"), "__new_vec", "__new_size"))
        taken = F.broadcast(made.select("__field", F.col("__small").alias("topic_id"), F.lit(True).alias("__taken")))
        moved = state.join(gone, ["__field", "merged_topic"], "left").join(grown, ["__field", "topic_id"], "left").join(taken, ["__field", "topic_id"], "left")
        state = moved.select(
            *keys, "__field", "topic_id", F.coalesce("__to", "merged_topic").alias("merged_topic"),
            F.when(F.col("__taken").isNull(), F.coalesce("__new_vec", "__vec")).alias("__vec"), F.coalesce("__new_size", "__size").alias("__size"),
        ).checkpoint()


def encode_with_candidates(docs: DataFrame, candidates: DataFrame, stop: list[str], dim: int = 256) -> DataFrame:
    """Documents with ``embedding`` by the default encoder, fitted on all of them, and ``terms``: those of their topic's candidates
    that they use.

    ``docs``: doc id, text, topic_id. Each text is split into terms once; the hashed counts, a few hundred bytes a document, are
    written to the shared folder, and the encoder is fitted on them.
    """
    path = scratch_path(docs.sparkSession, "hashed-terms")
    split = _used(_encoder_terms(docs, stop), "__terms", candidates)
    _hashed(dim).transform(split).drop("__terms", "text").write.parquet(path)
    counted = docs.sparkSession.read.parquet(path)
    if counted.isEmpty():
        return counted.withColumn("embedding", F.lit(None).cast("array<float>")).drop("__tf")
    encoded = Pipeline(stages=_weighing()).fit(counted).transform(counted)
    return encoded.withColumn("embedding", vector_to_array("__vec", "float32")).drop("__tf", "__idf", "__vec")


def _used(docs: DataFrame, every: str, candidates: DataFrame) -> DataFrame:
    """Add ``terms``: the candidates of a document's topic among the terms in column ``every``."""
    lists = candidates.groupBy("topic_id").agg(F.collect_set("term").alias("__wanted"))
    found = join_small(docs, lists, ["topic_id"], "left")
    none = F.array().cast("array<string>")
    return found.withColumn("terms", F.coalesce(F.array_intersect(every, "__wanted"), none)).drop("__wanted")


#: Sums of so many (topic, term) pairs are held by a task; beyond them they are handed on and added up again behind the shuffle.
HELD_SUMS = 4096


def _term_means(docs: DataFrame) -> DataFrame:
    """(topic_id, term, term_vector): the mean vector of the topic's documents with the term in ``terms``. A task adds up its
    documents, so neither a vector is copied for each term nor a row of them sorted."""
    schema = T.StructType([docs.schema["topic_id"], T.StructField("term", T.StringType()), T.StructField("s", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, list] = {}

        def held() -> pd.DataFrame:
            rows = [(topic, term, s, n) for (topic, term), (s, n) in sums.items()]
            return pd.DataFrame(rows, columns=schema.names)

        for pdf in frames:
            x = np.stack(pdf["embedding"].to_numpy())
            at: dict[tuple, list] = {}
            for row, (topic, terms) in enumerate(zip(pdf["topic_id"], pdf["terms"])):
                for term in terms:
                    at.setdefault((topic, term), []).append(row)
            for pair, rows in at.items():
                one = sums.setdefault(pair, [0.0, 0])
                one[0], one[1] = one[0] + x[rows].sum(axis=0, dtype="float64"), one[1] + len(rows)
            if len(sums) > HELD_SUMS:
                yield held()
                sums.clear()
        if sums:
            yield held()

    parts = docs.filter(F.size("terms") > 0).select("topic_id", "terms", "embedding").mapInPandas(add, schema)
    scaled = parts.withColumn("m", array_to_vector(F.transform("s", lambda v: v / F.col("n"))))
    mean = Summarizer.mean(F.col("m"), F.col("n").cast("double"))
    return scaled.groupBy("topic_id", "term").agg(vector_to_array(mean).alias("term_vector"))


def keyphrases(docs: DataFrame, candidates: DataFrame, stop: list[str], n: int = 10) -> DataFrame:
    """Re-rank candidate terms of each topic by how close the mean vector of the documents using them is to its centroid.

    ``docs``: doc id, text, embedding, topic_id; or ``terms`` of ``encode_with_candidates`` instead of the text.
    ``candidates``: topic_id, term (a short list per topic).
    """
    centroids = mean_vectors(docs, ["topic_id"]).select("topic_id", "centroid")
    if "terms" not in docs.columns:
        docs = _used(with_terms(docs.select("topic_id", "embedding", "text"), stop, "__terms"), "__terms", candidates)
    pair = join_small(_term_means(docs), centroids, ["topic_id"], "inner")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    lengths = F.sqrt(dot("term_vector", "term_vector") * dot("centroid", "centroid"))
    cosine = F.coalesce(F.try_divide(dot("term_vector", "centroid"), lengths), F.lit(0.0))  # a vector of zeros is like none
    scored = pair.select("topic_id", "term", cosine.alias("similarity"))
    return keep_top(scored, ["topic_id"], [F.floor(F.col("similarity") * 1e9 + 0.5).desc(), F.col("term")], n, "term_rank")
