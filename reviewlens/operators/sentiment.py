"""Aspect sentiment: scoreable rows -> sentences -> scores -> review -> product x aspect -> net -> heatmap."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens import config as cfg
from reviewlens.functions import scoring as sc
from reviewlens.functions import text as tx
from reviewlens.functions.numeric import exact_avg, round_half_up, share_pct
from reviewlens.operators.explode import to_rows
from reviewlens.session import ensure_checkpoint_dir

# -- rows and sentences -----------------------------------------------------------


def scoreable(df: DataFrame, fields: list[str] = ("likes", "dislikes")) -> DataFrame:
    """Rows worth scoring, with their aspect term."""
    keep = F.col("text_field").isin(*fields) & tx.nonblank(F.col("text"))
    if "is_noise" in df.columns:
        keep = keep & ~F.coalesce(F.col("is_noise"), F.lit(False))
    if "macro_group" in df.columns:
        keep = keep & F.col("macro_group").isNotNull() & ~F.col("macro_group").isin(*cfg.EXCLUDED_GROUPS)
    aspect = tx.aspect_term(F.col("group_label")) if "group_label" in df.columns else F.lit("general")
    return df.filter(keep).withColumn("aspect_term", aspect)


SENTENCE_CARRY = [
    "review_id", "product_id", "product_name", "reviewer_company_size", "reviewer_industry", "overall_rating",
    "is_incentivized", "review_date", "switched_from_product", "text_field", "topic_id", "probability",
    "top_keywords", "label", "macro_group", "group_label", "aspect_term", "is_noise", "is_product_cluster",
]


def split_sentences(df: DataFrame, min_len: int = cfg.MIN_SENTENCE_CHARS) -> DataFrame:
    """One row per sentence with its index and the number of sentences."""
    carry = [c for c in SENTENCE_CARRY if c in df.columns]
    whole = F.col("__whole")
    parts = (
        df.select(*carry, tx.strip(F.col("text")).alias("__whole"))
        .select(*carry, "__whole", tx.long_pieces(whole, min_len).alias("__pieces"))
        .select(*carry, tx.pieces_or_whole(F.col("__pieces"), whole, min_len).alias("__parts"))
        .withColumn("n_sentences", F.size("__parts"))
    )
    rows = to_rows(parts, "__parts", [*carry, "n_sentences"], "sentence", "sentence_idx")
    return rows.select(*carry, "sentence", "sentence_idx", "n_sentences")


def whole_texts(df: DataFrame) -> DataFrame:
    """The alternative without a split: each text is its own single sentence."""
    carry = [c for c in SENTENCE_CARRY if c in df.columns]
    return df.select(*carry, F.col("text").alias("sentence"), F.lit(0).alias("sentence_idx"), F.lit(1).alias("n_sentences"))


def relevant_sentences(df: DataFrame, threshold: float) -> DataFrame:
    """Sentences that mention enough of their topic's keywords; without keywords a sentence stays."""
    if threshold <= 0:
        return df
    overlap = tx.keyword_overlap(F.col("sentence"), F.col("top_keywords"))
    return df.filter(F.coalesce(overlap, F.lit(1.0)) >= threshold)


# -- scorers --------------------------------------------------------------------

SCORE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), False) for c in ("positive", "neutral", "negative")]
)
AspectScorer = Callable[[pd.DataFrame], pd.DataFrame]


def with_rating(df: DataFrame, probabilities: dict[str, Column]) -> DataFrame:
    """Label, rating and rounded probabilities from the three unrounded ones."""
    return df.withColumns(
        {
            "sentiment_label": sc.top_label(probabilities),
            "absa_rating": sc.rating(probabilities),
            **{k: round_half_up(probabilities[k], 4) for k in ("positive", "neutral", "negative")},
        }
    )


def score_with_lexicon(df: DataFrame, lexicon: dict[str, int] | None = None) -> DataFrame:
    """Built-in scorer: column expressions only, so the rows never leave the JVM."""
    lexicon = lexicon or cfg.SENTIMENT_LEXICON
    tokens = df.withColumn("__words", tx.words(F.col("sentence")))
    hits = tokens.withColumns({f"__{n}": sc.lexicon_hits(F.col("__words"), lexicon, s) for n, s in (("pos", 1), ("neg", -1))})
    probabilities = sc.lexicon_probabilities(F.col("__pos"), F.col("__neg"))
    return with_rating(hits, probabilities).drop("__words", "__pos", "__neg")


#: A pair on more than this part of all rows is heavy. There are fewer such pairs than that, whatever the data.
HEAVY_PART = 1000


def pair_key(sentence: Column, aspect: Column) -> Column:
    """128 bits that stand for a (sentence, aspect) pair; null differs from every text."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.md5(F.concat(part(sentence), F.lit("|"), part(aspect)).cast("binary"))


def infer(
    df: DataFrame,
    scorer_factory: Callable[[], AspectScorer],
    batch_size: int = 128,
    partitions: int | None = None,
    key: Callable[[Column, Column], Column] = pair_key,
    heavy_part: int = HEAVY_PART,
) -> DataFrame:
    """Score (sentence, aspect) pairs with a plugged-in model and join the scores back.

    ``scorer_factory`` runs once per task and returns a function from a frame with ``sentence``, ``aspect_term`` and
    ``pair`` to one with ``positive``, ``neutral``, ``negative``. Every distinct pair is scored once; the distinct
    also spreads the pairs evenly over tasks, so a sentence copied many times costs one call. A class the model
    does not have falls back to 0.33 / 0.34 / 0.33.

    The rows are written once with the ``key`` of their pair, so what made them runs once. Scores come back over the key, not
    over the text: those of heavy pairs are broadcast, so a sentence on a third of all rows stays where its rows are, and the
    others go by a shuffle in which no key has more rows than ``1 / heavy_part`` of all. Different pairs that share a key are
    found when the keys are counted; rows of such keys also compare the texts. Rows without a sentence are not scored.
    """
    missing = {"positive": 0.33, "neutral": 0.34, "negative": 0.33}
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn("__pair", key(F.col("sentence"), F.col("aspect_term"))).checkpoint()
    counted = rows.filter(F.col("sentence").isNotNull()).groupBy("__pair", "sentence", "aspect_term").agg(F.count(F.lit(1)).alias("__n"))
    pairs = counted.repartition(partitions, "__pair") if partitions else counted

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for big in batches:
            for start in range(0, len(big), batch_size):
                pdf = big.iloc[start : start + batch_size].reset_index(drop=True)
                pdf["pair"] = pdf["sentence"] + " [SEP] " + pdf["aspect_term"]
                scores = scorer(pdf[["sentence", "aspect_term", "pair"]])
                out = pdf[["__pair", "sentence", "aspect_term", "__n"]].copy()
                for name, default in missing.items():
                    out[name] = scores[name].to_numpy("float64") if name in scores else default
                yield out

    schema = T.StructType(
        [*[T.StructField(c, T.StringType()) for c in ("__pair", "sentence", "aspect_term")], T.StructField("__n", T.LongType()), *SCORE_SCHEMA.fields]
    )
    scored = pairs.mapInPandas(run, schema)
    rated = with_rating(scored, {k: F.col(k) for k in missing}).checkpoint()
    keys = rated.groupBy("__pair").agg((F.count(F.lit(1)) > 1).alias("__shared"), F.sum("__n").alias("__rows"))
    scores = [c for c in rated.columns if c not in ("__pair", "sentence", "aspect_term", "__n")]
    found = rated.join(keys, "__pair").select(
        F.col("__pair").alias("__key"), "__shared", "__rows", *[F.when(F.col("__shared"), F.col(c)).alias(f"__{c}") for c in ("sentence", "aspect_term")],
        *[F.col(c).alias(f"__s_{c}") for c in scores],
    )
    same = ~F.col("__shared") | (F.col("sentence").eqNullSafe(F.col("__sentence")) & F.col("aspect_term").eqNullSafe(F.col("__aspect_term")))
    match = (F.col("__pair") == F.col("__key")) & same
    bound = rows.count() // heavy_part
    heavy = F.broadcast(found.filter(F.col("__rows") > bound))  # fewer than ``heavy_part`` keys
    some = rows.join(heavy, match)
    others = rows.join(heavy.select("__key").distinct(), F.col("__pair") == F.col("__key"), "left_anti").join(found.filter(F.col("__rows") <= bound), match, "left")
    wanted = [*df.columns, *[F.col(f"__s_{c}").alias(c) for c in scores]]
    return some.select(*wanted).unionByName(others.select(*wanted))


# -- roll-ups ---------------------------------------------------------------------

REVIEW_KEYS = [
    "review_id", "product_id", "product_name", "text_field", "macro_group", "group_label", "aspect_term",
    "reviewer_company_size", "overall_rating", "is_incentivized", "review_date", "switched_from_product",
]


def to_reviews(scored: DataFrame, null_keys: str = "keep") -> DataFrame:
    """Sentence scores -> one row per review, field and aspect.

    ``null_keys="drop"`` leaves out rows with a null in any key, as a pandas group-by does.
    """
    # The review fixes the columns that are carried along. Grouping on them too keeps this a hash aggregate, which cannot
    # hold text in its buffers and would have to sort all sentences.
    keys = [k for k in REVIEW_KEYS if k in scored.columns]
    if null_keys == "drop":
        scored = scored.dropna(subset=keys)
    label = F.col("sentiment_label")
    counted = scored.groupBy(*keys).agg(
        round_half_up(exact_avg(F.col("absa_rating"), 3), 3).alias("absa_rating"),
        F.min("absa_rating").alias("absa_rating_min"),
        F.max("absa_rating").alias("absa_rating_max"),
        exact_avg(F.col("positive"), 4).alias("positive_avg"),
        exact_avg(F.col("neutral"), 4).alias("neutral_avg"),
        exact_avg(F.col("negative"), 4).alias("negative_avg"),
        F.count("sentence").alias("n_sentences"),
        *[F.count_if(label == k).alias(f"__{k}") for k in ("negative", "neutral", "positive")],
    )
    most = F.greatest("__negative", "__neutral", "__positive")
    majority = (
        F.when(F.col("__negative") == most, "negative").when(F.col("__neutral") == most, "neutral").otherwise("positive")
    )
    return counted.withColumn("sentiment_label", majority).drop("__negative", "__neutral", "__positive")


ASPECT_KEYS = ["product_name", "macro_group", "group_label", "aspect_term", "text_field"]


def to_product_aspect(reviews: DataFrame) -> DataFrame:
    """Review rows -> product x aspect x field."""
    n = F.count(F.lit(1))
    label = F.col("sentiment_label")
    flag = F.col("is_incentivized").cast("int")
    return reviews.groupBy(*ASPECT_KEYS).agg(
        round_half_up(exact_avg(F.col("absa_rating"), 3), 2).alias("avg_rating"),
        F.count("review_id").alias("n_reviews"),
        F.sum("n_sentences").alias("n_sentences"),
        *[share_pct(F.count_if(label == k), n).alias(f"pct_{k}") for k in ("positive", "neutral", "negative")],
        round_half_up(exact_avg(F.col("overall_rating"), 2), 2).alias("avg_overall_rating"),
        share_pct(F.sum(flag), F.count(flag)).alias("pct_incentivized"),
    )


def likes_vs_dislikes(aspects: DataFrame) -> DataFrame:
    """Full outer match of the likes and dislikes rows of each product and macro group.

    Both sides come from one table, so the match is one grouping instead of a self join that would compute everything
    upstream twice. A group holds the labels of one macro group of one product.
    """
    shared = ["avg_rating", "n_reviews", "pct_positive", "pct_negative"]
    likes = F.struct("group_label", *shared, "avg_overall_rating")
    dislikes = F.struct("group_label", *shared)
    sides = aspects.groupBy("product_name", "macro_group").agg(
        F.collect_list(F.when(F.col("text_field") == "likes", likes)).alias("__likes"),
        F.collect_list(F.when(F.col("text_field") == "dislikes", dislikes)).alias("__dislikes"),
    )
    both = (
        sides.filter((F.size("__likes") > 0) | (F.size("__dislikes") > 0))
        .select("product_name", "macro_group", F.explode_outer("__likes").alias("l"), "__dislikes")
        .select("product_name", "macro_group", "l", F.explode_outer("__dislikes").alias("d"))
    )
    named = {"avg_rating": "rating", "n_reviews": "n_reviews", "pct_positive": "pct_positive", "pct_negative": "pct_negative"}
    return both.select(
        "product_name",
        "macro_group",
        F.col("l.group_label").alias("group_label"),
        F.col("d.group_label").alias("dislikes_label"),
        *[F.col(f"l.{src}").alias(f"likes_{dst}") for src, dst in named.items()],
        F.col("l.avg_overall_rating").alias("avg_overall_rating"),
        *[F.col(f"d.{src}").alias(f"dislikes_{dst}") for src, dst in named.items()],
    )


def net_scores(aspects: DataFrame, label: str = "coalesce", impute: float | None = cfg.NEUTRAL_RATING) -> DataFrame:
    """Net rating and sentiment gap per product and macro group.

    A missing side counts as neutral unless ``impute`` is None. ``label="likes"`` takes the group label from the likes
    side alone; ``"coalesce"`` falls back to the dislikes side, so groups seen only in complaints keep a name.
    """
    sides = likes_vs_dislikes(aspects)
    if label == "coalesce":
        sides = sides.withColumn("group_label", F.coalesce("group_label", "dislikes_label"))
    like, dislike = F.col("likes_rating"), F.col("dislikes_rating")
    if impute is not None:
        like, dislike = F.coalesce(like, F.lit(impute)), F.coalesce(dislike, F.lit(impute))
    return sides.drop("dislikes_label").withColumns(
        {
            "n_sides": F.col("likes_rating").isNotNull().cast("int") + F.col("dislikes_rating").isNotNull().cast("int"),
            "net_rating": round_half_up((like + dislike) / 2.0, 2),
            "sentiment_gap": round_half_up(like - (F.lit(6.0) - dislike), 2),
        }
    )


def sort_net(net: DataFrame) -> DataFrame:
    return net.orderBy(F.col("product_name").asc(), F.col("net_rating").desc(), F.col("macro_group").asc())


def heatmap(net: DataFrame, labels: list[str] | None = None, max_labels: int = 1000, other: str = "other aspects") -> DataFrame:
    """Product x aspect pivot of the mean net rating. Give ``labels`` to save the pass that finds them.

    No aspect is lost: where ``labels`` are given, rows with any other label make a last column ``other``.
    """
    rows = net.filter(F.col("group_label").isNotNull())
    if labels is None:
        found = [r[0] for r in rows.select("group_label").distinct().limit(max_labels + 1).collect()]
        if len(found) > max_labels:
            raise ValueError(f"more than {max_labels} aspects; give the labels of some, or use the long net table instead of a pivot")
        named, columns = rows, sorted(found)
    else:
        if other in labels:
            raise ValueError(f"{other!r} is a label; name the column of the others differently")
        named = rows.withColumn("group_label", F.when(F.col("group_label").isin(labels), F.col("group_label")).otherwise(F.lit(other)))
        columns = [*labels, other]
    mean = round_half_up(exact_avg(F.col("net_rating"), 2), 2)
    return named.groupBy("product_name").pivot("group_label", columns).agg(mean).orderBy("product_name")


def score_chain(classified: DataFrame, score: Callable[[DataFrame], DataFrame], threshold: float = 0.0) -> DataFrame:
    """Long table -> product x aspect x field table."""
    sentences = relevant_sentences(split_sentences(scoreable(classified)), threshold)
    return to_product_aspect(to_reviews(score(sentences)))


