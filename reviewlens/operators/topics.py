"""Topic words: terms, vocabulary, class-based TF-IDF, keywords and the topic info table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import text as tx
from reviewlens.operators import term_blocks as tb
from reviewlens.operators.dedup import keep_top
from reviewlens.operators.lookup import join_small, small
from reviewlens.session import ensure_checkpoint_dir

DEFAULT_STOP = cfg.ENGLISH_STOP + cfg.PRODUCT_STOP + cfg.META_STOP


def with_terms(docs: DataFrame, stop: list[str], out: str = "terms") -> DataFrame:
    """Add the one- and two-word terms of ``text`` without stop words."""
    kept = docs.withColumn("__kept", tx.content_words(F.col("text"), stop))
    return kept.withColumn(out, tx.with_phrases(F.col("__kept"))).drop("__kept")


def topic_texts(docs: DataFrame, min_chars: int = cfg.MIN_CHARS) -> DataFrame:
    """Replace ``text`` by the text that topics are built from: cleaned, without a leaked title (use_case only),
    abbreviations expanded, null when too short."""
    text, field = F.col("text"), F.col("text_field")
    return (
        docs.withColumn("text", tx.collapse(text))
        .withColumn("text", tx.null_tokens(text))
        .withColumn("text", F.when(field == "use_case", tx.strip_title(text)).otherwise(text))
        .withColumn("text", tx.expand_abbreviations(text))
        .withColumn("text", tx.min_chars(text, min_chars))
    )


def term_counts(docs: DataFrame, keys: list[str], stop: list[str] | None = None) -> DataFrame:
    """Occurrences of each one- and two-word term per topic. Each task adds up its own rows before the shuffle."""
    return tb.counts(docs, keys, stop or DEFAULT_STOP)


def vocabulary(counts: DataFrame, keys: list[str], min_df: int = cfg.MIN_DF, max_df: float = cfg.MAX_DF) -> DataFrame:
    """Terms whose number of topics lies inside the bounds; ``keys`` ends with the topic, fields before it stay apart."""
    fields = keys[:-1]
    topics = counts.select(*keys).distinct().groupBy(*fields).agg(F.count(F.lit(1)).alias("n_topics"))
    df = counts.groupBy(*fields, "term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("n").alias("term_total"))
    bounded = join_small(df, topics, fields, "inner") if fields else df.withColumn("n_topics", topics.scalar())
    return bounded.filter((F.col("doc_freq") >= min_df) & (F.col("doc_freq") <= F.col("n_topics") * max_df))


def vocabulary_counts(docs: DataFrame, keys: list[str], stop: list[str] | None = None, min_df: int = cfg.MIN_DF, max_df: float = cfg.MAX_DF) -> DataFrame:
    """(keys, term, n, doc_freq, term_total, n_topics): the counts of ``vocabulary``'s terms, straight from the texts.

    The counts of all terms are never written: the lower bound holds inside the tasks that add them up, and what is left is
    written to the checkpoint folder once.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    fields = keys[:-1]
    found = tb.frequent(docs, keys, stop or DEFAULT_STOP, min_df).checkpoint()
    topics = found.filter(F.col("term").isNull()).select(*keys).distinct().groupBy(*fields).agg(F.count(F.lit(1)).alias("n_topics"))
    counts = found.filter(F.col("term").isNotNull())
    bounded = join_small(counts, topics, fields, "inner") if fields else counts.withColumn("n_topics", topics.scalar())
    return bounded.filter(F.col("doc_freq") <= F.col("n_topics") * max_df)


def ctfidf(
    docs: DataFrame,
    keys: list[str],
    stop: list[str] | None = None,
    min_df: int = cfg.MIN_DF,
    max_df: float = cfg.MAX_DF,
    damp: bool = True,
) -> DataFrame:
    """Weight of each term in each topic: (square root of) its share of the topic times log(1 + A / total).

    A is the mean number of term occurrences per topic, rounded down.

    Nothing is shuffled by topic or field, of which there are few.
    """
    fields = keys[:-1]
    kept = vocabulary_counts(docs, keys, stop, min_df, max_df)
    sizes = small(kept.groupBy(*keys).agg(F.sum("n").alias("topic_total")))
    if fields:
        means = sizes.groupBy(*fields).agg(F.floor(F.avg("topic_total")).alias("mean_total"))
        sized = join_small(kept.join(sizes, keys), means, fields, "inner")
    else:
        mean = sizes.agg(F.floor(F.avg("topic_total"))).scalar()
        sized = kept.join(sizes, keys).withColumn("mean_total", mean)
    share: Column = F.col("n") / F.col("topic_total").cast("double")
    weight = (F.sqrt(share) if damp else share) * F.ln(F.lit(1.0) + F.col("mean_total") / F.col("term_total").cast("double"))
    return sized.select(*keys, "term", "n", weight.alias("weight"))


def top_terms(weights: DataFrame, keys: list[str], n: int = cfg.TOP_TERMS) -> DataFrame:
    """Heaviest terms per topic; equal weights in term order (weights are compared at nine decimals)."""
    return keep_top(weights, keys, [F.floor(F.col("weight") * 1e9 + 0.5).desc(), F.col("term").asc()], n, "term_rank")


def clean_keywords(ranked: DataFrame, keys: list[str], stop: list[str] = cfg.ALL_STOP, n: int = cfg.TOP_TERMS) -> DataFrame:
    """Up to ``n`` ranked terms per topic without stop phrases, short words and numbers, as one text per topic."""
    w = F.lower(F.trim("term"))
    heads, tails = [s + " " for s in stop], [" " + s for s in stop]
    starts = F.exists(F.array(*map(F.lit, heads)), lambda s: F.startswith(w, s))
    ends = F.exists(F.array(*map(F.lit, tails)), lambda s: F.endswith(w, s))
    good = ~w.isin(*stop) & ~starts & ~ends & (F.length(w) > 2) & ~F.rlike(w, F.lit(r"^\p{N}+$"))
    kept = keep_top(ranked.filter(good), keys, [F.col("term_rank").asc()], n, "__kept")
    words = F.sort_array(F.collect_list(F.struct("__kept", "term")))
    return kept.groupBy(*keys).agg(F.array_join(F.transform(words, lambda s: s["term"]), ", ").alias("top_keywords"))


def topic_info(docs: DataFrame, keywords: DataFrame) -> DataFrame:
    """Documents, keywords, label and product-cluster flag of every topic that has documents."""
    keys = [k for k in ("text_field", "topic_id") if k in docs.columns]
    counts = docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("doc_count"))
    outlier = F.col("topic_id") == -1
    words = F.when(outlier, cfg.OUTLIER_KEYWORDS).otherwise(F.coalesce(F.col("top_keywords"), F.lit(cfg.UNLABELLED)))
    return (
        counts.join(keywords, keys, "left")
        .withColumn("top_keywords", words)
        .withColumn("label", tx.label_of(F.col("top_keywords")))
        .withColumn("is_product_cluster", ~outlier & tx.names_only_products(F.col("top_keywords")))
    )
