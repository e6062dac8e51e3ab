"""Tables for reading: rankings, shares, switching, incentives, segments and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reviewlens.functions.numeric import exact_avg, exact_sum, round_half_up, share_pct
from reviewlens.operators.dedup import keep_top
from reviewlens.operators.explode import to_rows
from reviewlens.operators.lookup import join_small


def with_share(df: DataFrame, value: str, out: str, digits: int = 1) -> DataFrame:
    """Percent of the grand total of ``value``; the total is one scalar, not a one-partition window."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, share_pct(F.col(value), total, digits))


# -- topics ------------------------------------------------------------------------


def topic_counts(docs: DataFrame, keys: list[str]) -> DataFrame:
    return docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("doc_count"))


def valid_topics(info: DataFrame) -> DataFrame:
    """Topics that are neither outliers nor mere product-name clusters."""
    return info.filter((F.col("topic_id") != -1) & ~F.col("is_product_cluster"))


def keep_valid(docs: DataFrame, info: DataFrame) -> DataFrame:
    keys = [k for k in ("text_field", "topic_id") if k in info.columns]
    return join_small(docs, valid_topics(info).select(*keys), keys, "left_semi")


def topic_distribution(docs: DataFrame, info: DataFrame) -> DataFrame:
    """Documents per product and valid topic with label and keywords, product ascending and largest first."""
    keys = [k for k in ("text_field", "topic_id") if k in info.columns]
    # Counting first leaves product x topic rows for the join instead of documents.
    counts = topic_counts(docs, ["product_name", *keys])
    valid = valid_topics(info).select(*keys, "label", "top_keywords")
    return join_small(counts, valid, keys, "inner").orderBy(
        F.col("product_name").asc(), F.col("doc_count").desc(), F.col("topic_id").asc()
    )


def _field(df: DataFrame) -> list[str]:
    """The text field is a key wherever a table has it: topic ids of different fields are different topics."""
    return ["text_field"] if "text_field" in df.columns else []


def dominant_topic(dist: DataFrame) -> DataFrame:
    """Largest topic of each product and field."""
    return keep_top(dist, ["product_name", *_field(dist)], [F.col("doc_count").desc(), F.col("topic_id").asc()])


def largest_topics(info: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` largest valid topics of each field, or of the whole table where it has no fields."""
    order = [F.col("doc_count").desc(), F.col("topic_id").asc()]
    valid = valid_topics(info)
    return keep_top(valid, _field(info), order, n) if _field(info) else valid.orderBy(*order).limit(n)


def largest_topics_per_group(info: DataFrame, n: int = 3) -> DataFrame:
    return keep_top(
        info.filter(~F.col("is_noise")), [*_field(info), "macro_group"], [F.col("doc_count").desc(), F.col("topic_id").asc()], n, "topic_rank"
    )


def topic_overview(info: DataFrame) -> DataFrame:
    """Feature topics, product clusters, outliers and total documents per field."""
    outlier = F.col("topic_id") == -1
    cluster = F.col("is_product_cluster") & ~outlier
    docs = F.col("doc_count")
    return info.groupBy("text_field").agg(
        F.count_if(~outlier & ~cluster).alias("feature_topics"),
        F.count_if(cluster).alias("product_clusters"),
        F.coalesce(F.sum(F.when(cluster, docs)), F.lit(0)).alias("product_cluster_docs"),
        F.coalesce(F.sum(F.when(outlier, docs)), F.lit(0)).alias("outlier_docs"),
        share_pct(F.coalesce(F.sum(F.when(outlier, docs)), F.lit(0)), F.sum(docs)).alias("outlier_pct"),
        F.sum(docs).alias("total_docs"),
    )


def macro_summary(groups: DataFrame, info: DataFrame, keyword_chars: int = 40, top: int = 3) -> DataFrame:
    """Per field and declared group: topics, documents, share of the field and the keywords of its largest topics.

    Empty groups stay in, other columns of ``groups`` (such as the description) are carried along, and the groups with most
    documents come first. ``groups`` without a field column apply to every field of ``info``.
    """
    keys = [*_field(info), "macro_group"]
    if _field(info) and "text_field" not in groups.columns:
        groups = groups.crossJoin(F.broadcast(info.select("text_field").distinct()))  # a row per field: there are a handful
    clean = info.filter(~F.col("is_noise") & (F.col("topic_id") != -1))
    ranked = clean.withColumn(
        "__rank",
        F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("doc_count").desc(), F.col("topic_id").asc())),
    )
    slot = lambda i: F.max(F.when(F.col("__rank") == i, F.substring("top_keywords", 1, keyword_chars)))
    per_group = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_topics"),
        F.sum("doc_count").alias("total_docs"),
        F.concat_ws(" | ", *[slot(i) for i in range(1, top + 1)]).alias("top_keywords"),
    )
    summary = groups.join(per_group, keys, "left").withColumns(
        {
            "n_topics": F.coalesce("n_topics", F.lit(0)),
            "total_docs": F.coalesce("total_docs", F.lit(0)),
            "top_keywords": F.coalesce("top_keywords", F.lit("")),
        }
    )
    # One row per group: the window over a field's groups is small.
    whole = F.sum("total_docs").over(Window.partitionBy(*(_field(info) or [F.lit(0)])))
    shared = summary.withColumn("pct_docs", share_pct(F.col("total_docs"), whole))
    return shared.orderBy(*_field(info), F.col("total_docs").desc(), "macro_group")


def outlier_rate(before_after: DataFrame) -> DataFrame:
    """Outliers before and after reassignment per field (columns topic_before, topic_id)."""
    n = F.count(F.lit(1))
    before, after = F.count_if(F.col("topic_before") == -1), F.count_if(F.col("topic_id") == -1)
    return before_after.groupBy("text_field").agg(
        n.alias("total_docs"),
        before.alias("outliers_before"),
        share_pct(before, n).alias("outlier_pct_before"),
        after.alias("outliers_after"),
        share_pct(after, n).alias("outlier_pct_after"),
    )


# -- switching --------------------------------------------------------------------


def switch_rate(reviews: DataFrame) -> DataFrame:
    """Share of reviews that name a prior product, per product and overall (product_name null)."""
    switched = F.count("switched_from_product")
    return reviews.rollup("product_name").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        switched.alias("n_switched"),
        share_pct(switched, F.count(F.lit(1))).alias("switch_pct"),
    )


def switch_origins(reviews: DataFrame, n: int = 10) -> DataFrame:
    """Most named prior products; a review that names several counts for each."""
    names = reviews.select(F.split("switched_from_product", r" \| ").alias("__names"))
    counts = to_rows(names, "__names", [], "origin").groupBy("origin").agg(F.count(F.lit(1)).alias("n_reviews"))
    return counts.orderBy(F.col("n_reviews").desc(), F.col("origin").asc()).limit(n)


# -- sentiment ------------------------------------------------------------------------


def sentiment_mix(scored: DataFrame) -> DataFrame:
    """Share of each label over all scored sentences, with the overall mean rating."""
    counts = scored.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.sum(F.floor(F.col("absa_rating") * 1000.0 + 0.5).cast("bigint")).alias("__milli"),
    )
    whole = counts.agg((F.sum("__milli") / (F.sum("n_sentences") * 1000.0)).alias("m")).scalar()
    return with_share(counts.withColumn("avg_rating", round_half_up(whole, 2)), "n_sentences", "pct").drop("__milli")


def sentences_per_review(sentences: DataFrame) -> DataFrame:
    n, reviews = F.count(F.lit(1)), F.countDistinct("review_id")
    return sentences.agg(
        n.alias("n_sentences"),
        reviews.alias("n_reviews"),
        round_half_up(n.cast("double") / F.greatest(reviews, F.lit(1)), 1).alias("avg_per_review"),
    )


def rankings(net: DataFrame) -> DataFrame:
    """Mean net rating by aspect and by product, best first, in one pass."""
    mean = exact_avg(F.col("net_rating"), 2)
    return (
        net.groupingSets([["group_label"], ["product_name"]], "group_label", "product_name")
        .agg(F.grouping("group_label").alias("__by_product"), round_half_up(mean, 2).alias("avg_net_rating"))
        .select(
            F.when(F.col("__by_product") == 1, "product").otherwise("aspect").alias("dimension"),
            F.when(F.col("__by_product") == 1, F.col("product_name")).otherwise(F.col("group_label")).alias("name"),
            "avg_net_rating",
        )
        .filter(F.col("name").isNotNull())
        .orderBy("dimension", F.col("avg_net_rating").desc(), "name")
    )


def aspect_spread(aspects: DataFrame) -> DataFrame:
    """How far products lie apart on each aspect and field."""
    rating = F.col("avg_rating")
    return aspects.groupBy("aspect_term", "text_field").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"),
        round_half_up(F.max(rating) - F.min(rating), 2).alias("rating_range"),
        F.min(F.struct(rating.alias("r"), F.col("product_name"))).getField("product_name").alias("weakest_product"),
        F.min(F.struct((-rating).alias("r"), F.col("product_name"))).getField("product_name").alias("strongest_product"),
    )


def best_per_aspect(net: DataFrame, vendors: DataFrame, vendor: str) -> DataFrame:
    """Winning products per aspect, and how far the best product of one vendor lies behind."""
    w = Window.partitionBy("group_label").orderBy(F.col("net_rating").desc())
    winners = net.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1).drop("__rank")
    own = (
        net.join(vendors.select("product_name", "vendor"), "product_name")
        .filter(F.col("vendor") == vendor)
        .groupBy("group_label")
        .agg(F.max("net_rating").alias("vendor_best"))
    )
    return winners.join(own, "group_label", "left").select(
        "group_label",
        "product_name",
        "net_rating",
        "vendor_best",
        round_half_up(F.col("net_rating") - F.col("vendor_best"), 2).alias("vendor_gap"),
    )


def pain_points(classified: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent groups among complaints, noise left out."""
    rows = classified.filter(
        (F.col("text_field") == "dislikes") & ~F.coalesce(F.col("is_noise"), F.lit(False)) & F.col("group_label").isNotNull()
    )
    counts = rows.groupBy("group_label").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), F.col("group_label").asc()).limit(n)


# -- bias, segments, trends ---------------------------------------------------------------


def incentive_bias(reviews: DataFrame, rating: str = "overall_rating") -> DataFrame:
    """Mean rating of incentivised against organic reviews per product."""
    r, inc = F.col(rating), F.coalesce(F.col("is_incentivized"), F.lit(False))
    paid, organic = exact_avg(F.when(inc, r), 2), exact_avg(F.when(~inc, r), 2)
    return reviews.groupBy("product_name").agg(
        F.count_if(inc).alias("n_incentivized"),
        F.count_if(~inc).alias("n_organic"),
        round_half_up(paid, 2).alias("avg_incentivized"),
        round_half_up(organic, 2).alias("avg_organic"),
        round_half_up(paid - organic, 2).alias("bias"),
    )


def segment_trend(reviews: DataFrame, date: str, segment: str, value: Column, digits: int = 2) -> DataFrame:
    """Volume and mean value per month and segment; ``value`` carries ``digits`` decimals."""
    return reviews.groupBy(F.trunc(date, "MM").alias("month"), F.col(segment).alias("segment")).agg(
        F.count(F.lit(1)).alias("n_reviews"), round_half_up(exact_avg(value, digits), 2).alias("avg_value")
    )


def segment_cube(reviews: DataFrame, a: str, b: str, value: Column, digits: int = 2) -> DataFrame:
    """Volume and mean value over every combination of two segments, totals included."""
    return reviews.cube(F.col(a).alias("segment"), F.col(b).alias("industry")).agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("n_reviews"),
        round_half_up(exact_avg(value, digits), 2).alias("avg_value"),
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Items and duration per source and product with totals (null keys)."""
    return log.rollup("actor_key", "product_key").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("item_count").alias("item_count"),
        (exact_sum(F.col("duration_secs"), 1).cast("double") / 10.0).alias("duration_secs"),
    )
