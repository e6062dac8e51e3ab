import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import marts, quality, reshape
from reviewlens.operators import sentiment as se
from reviewlens.plans import chain as ch

SF = "/root/testdata/sf0.001"
SCORED = "review_id string, product_name string, text_field string, macro_group string, group_label string, aspect_term string, " \
    "overall_rating double, is_incentivized boolean, switched_from_product string, sentence string, positive double, " \
    "neutral double, negative double, sentiment_label string, absa_rating double"  # fmt: skip


def scored_row(review, label, rating, switched=None, field="likes", group="g", product="p"):
    return (review, product, field, group, group.upper(), group, 4.0, review == "r1", switched, "s", 0.2, 0.3, 0.5, label, rating)


def test_review_rollup(spark):
    rows = [scored_row("r1", "positive", 5.0), scored_row("r1", "negative", 1.0), scored_row("r2", "neutral", 3.0, "Old")]
    df = spark.createDataFrame(rows, SCORED)
    got = {r.review_id: r for r in se.to_reviews(df).collect()}
    assert (got["r1"].absa_rating, got["r1"].absa_rating_min, got["r1"].absa_rating_max) == (3.0, 1.0, 5.0)
    assert got["r1"].sentiment_label == "negative"  # a tie goes to the worse label
    assert got["r1"].n_sentences == 2 and got["r2"].sentiment_label == "neutral"
    dropped = se.to_reviews(df, null_keys="drop").collect()
    assert [r.review_id for r in dropped] == ["r2"]


def test_product_aspect(spark):
    rows = [scored_row("r1", "positive", 5.0), scored_row("r2", "neutral", 3.0), scored_row("r3", "neutral", 3.0)]
    row = se.to_product_aspect(se.to_reviews(spark.createDataFrame(rows, SCORED))).first()
    assert (row.avg_rating, row.n_reviews, row.n_sentences) == (3.67, 3, 3)
    assert (row.pct_positive, row.pct_neutral, row.pct_negative, row.pct_incentivized) == (33.3, 66.7, 0.0, 33.3)


ASPECTS = "product_name string, macro_group string, group_label string, aspect_term string, text_field string, avg_rating double, " \
    "n_reviews bigint, n_sentences bigint, pct_positive double, pct_neutral double, pct_negative double, " \
    "avg_overall_rating double, pct_incentivized double"  # fmt: skip


def aspect(product, group, field, rating, label=None):
    return (product, group, label or group, group, field, rating, 1, 1, 50.0, 25.0, 25.0, 4.0, 0.0)


def test_net_scores(spark):
    rows = [aspect("p", "both", "likes", 4.82), aspect("p", "both", "dislikes", 2.0), aspect("p", "liked", "likes", 4.0),
            aspect("p", "hated", "dislikes", 1.5)]
    df = spark.createDataFrame(rows, ASPECTS)
    net = {r.macro_group: r for r in se.net_scores(df).collect()}
    assert (net["both"].net_rating, net["both"].sentiment_gap, net["both"].n_sides) == (3.41, 0.82, 2)
    assert (net["liked"].net_rating, net["liked"].sentiment_gap, net["liked"].n_sides) == (3.5, 1.0, 1)
    assert (net["hated"].net_rating, net["hated"].sentiment_gap, net["hated"].group_label) == (2.25, -1.5, "hated")
    as_is = {r.macro_group: r for r in se.net_scores(df, label="likes", impute=None).collect()}
    assert as_is["hated"].group_label is None and as_is["liked"].net_rating is None
    heat = se.heatmap(se.net_scores(df)).first().asDict()
    assert heat == {"product_name": "p", "both": 3.41, "hated": 2.25, "liked": 3.5}
    assert se.heatmap(se.net_scores(df.filter("text_field = 'dislikes'"), label="likes")).columns == ["product_name"]


def test_two_labels_in_one_group_pair_up(spark):
    rows = [aspect("p", "g", "likes", 4.0, "A"), aspect("p", "g", "likes", 5.0, "B"), aspect("p", "g", "dislikes", 2.0, "C"),
            aspect("q", "g", "use_case", 2.0)]
    got = sorted((r.group_label, r.net_rating) for r in se.net_scores(spark.createDataFrame(rows, ASPECTS)).collect())
    assert got == [("A", 3.0), ("B", 3.5)]


def test_chain_properties(spark):
    net = ch.net(spark, SF).collect()
    assert all(1.0 <= r.net_rating <= 5.0 for r in net)
    assert all(abs(r.sentiment_gap - (2 * r.net_rating - 6)) <= 0.0101 for r in net)
    aspects = ch.aspects(spark, SF).collect()
    assert all(abs(r.pct_positive + r.pct_neutral + r.pct_negative - 100) <= 0.2 for r in aspects)
    sentences = ch.sentences(spark, SF)
    per_review = sentences.groupBy("review_id", "text_field").agg(F.count("*").alias("n"), F.max("n_sentences").alias("m"))
    assert per_review.filter("n <> m").count() == 0


def test_rounding_is_half_up_in_binary(one):
    assert one("x double", (0.125,), round_half_up(F.col("x"), 2)) == [0.13]
    assert one("x double", (-1.5,), round_half_up(F.col("x"), 0)) == [-1.0]


def test_group_application(spark):
    docs = spark.createDataFrame([("a", -1), ("b", 0), ("c", 9), ("d", None)], "review_id string, topic_id int")
    mapping = spark.createDataFrame([(0, "core", "Core")], "topic_id int, macro_group string, group_label string")
    got = {r.review_id: (r.macro_group, r.is_noise) for r in reshape.with_noise_flag(reshape.apply_groups(docs, mapping)).collect()}
    assert got == {"a": ("outlier", True), "b": ("core", False), "c": ("unassigned", False), "d": ("unassigned", False)}


def test_macro_summary_keeps_empty_groups(spark):
    groups = spark.createDataFrame([("core", "Core"), ("none", "None")], "macro_group string, group_label string")
    info = spark.createDataFrame(
        [(n, "core", 10 - n, f"{'x' * 50}{n}", False) for n in range(4)] + [(-1, "core", 99, "out", False), (8, "core", 9, "noise", True)],
        "topic_id int, macro_group string, doc_count bigint, top_keywords string, is_noise boolean",
    )
    rows = {r.macro_group: r for r in marts.macro_summary(groups, info).collect()}
    assert (rows["core"].n_topics, rows["core"].total_docs, rows["core"].pct_docs) == (4, 34, 100.0)
    assert rows["core"].top_keywords == " | ".join(["x" * 40] * 3)
    assert (rows["none"].n_topics, rows["none"].total_docs, rows["none"].top_keywords) == (0, 0, "")


def test_shares_add_up(spark):
    mix = marts.sentiment_mix(ch.scored(spark, SF)).collect()
    assert abs(sum(r.pct for r in mix) - 100) <= 0.2


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, "a")], "x int, y string")
    assert [(r.column_name, r.null_pct) for r in quality.null_profile(df).collect()] == [("x", 33.3), ("y", 33.3)]
    manifest = {r.column_name: r for r in quality.manifest(df).collect()}
    assert (manifest["y"].data_type, manifest["y"].example, manifest["x"].position) == ("string", "a", 1)


# The eight labelled pairs that a scorer has to pass before it is used (fixed values).
PAIRS = [
    ("The financial reporting is absolutely fantastic and saves us hours", "financial reporting", "positive"),
    ("Customer support takes weeks to respond to any ticket", "customer support", "negative"),
    ("Very easy to navigate and the interface is intuitive", "ease of use", "positive"),
    ("Implementation was a nightmare, took 14 months and cost 3x budget", "implementation", "negative"),
    ("The pricing went up 40% with no added value", "pricing", "negative"),
    ("Bank reconciliation works perfectly and saves hours each month", "bank reconciliation", "positive"),
    ("Reporting is limited and very difficult to customize", "reporting", "negative"),
    ("The inventory management module is comprehensive and accurate", "inventory management", "positive"),
]


def test_scorer_acceptance(spark):
    df = spark.createDataFrame(PAIRS, "sentence string, aspect_term string, expected string")
    rows = quality.scorer_acceptance(se.score_with_lexicon(df)).collect()
    # One complaint carries no sentiment word of its own ("takes weeks"): the general lexicon misses it, and the band says so.
    assert {r.band for r in rows} == {"warning"} and {r.pass_pct for r in rows} == {87.5}


def test_ratings_of_long_texts_stay_in_range(spark):
    rows = [("great " * 5000,), ("bad " * 5000,), ("great bad " * 2000,), ("plain",)]
    got = [(r.absa_rating, r.sentiment_label) for r in se.score_with_lexicon(spark.createDataFrame(rows, "sentence string")).collect()]
    assert got[0] == (5.0, "positive") and got[1] == (1.0, "negative") and all(1 <= v <= 5 for v, _ in got)


def test_infer_scores_each_pair_once(spark):
    df = spark.createDataFrame([("s", "a", n) for n in range(50)] + [("t", None, 50)], "sentence string, aspect_term string, n int")
    df = df.fillna("general", ["aspect_term"])

    def factory():
        def score(pdf):
            assert len(pdf) == len(pdf.drop_duplicates()) and list(pdf["pair"]) == list(pdf["sentence"] + " [SEP] " + pdf["aspect_term"])
            return pd.DataFrame({"positive": [0.9] * len(pdf), "negative": [0.1] * len(pdf)})

        return score

    rows = se.infer(df, factory, batch_size=1).collect()
    assert len(rows) == 51 and {r.neutral for r in rows} == {0.34} and {r.sentiment_label for r in rows} == {"positive"}
    assert {r.absa_rating for r in rows} == {round(0.9 * 5 + 0.34 * 3 + 0.1, 3)}


def test_best_topic_ties(spark):
    from reviewlens.operators.dedup import keep_best_topic

    rows = [("a", 5, 0.5), ("a", 2, 0.5), ("a", 1, 0.1), ("b", 3, None), ("b", 4, 0.0)]
    got = keep_best_topic(spark.createDataFrame(rows, "review_id string, topic_id int, probability double")).collect()
    assert {(r.review_id, r.topic_id) for r in got} == {("a", 2), ("b", 4)}


def test_long_table(spark):
    reviews = spark.createDataFrame(
        [("1", "p", "good", None, "use"), ("2", "p", None, "bad", None)], "review_id string, product_name string, likes string, dislikes string, use_case string"
    )
    docs = spark.createDataFrame([("1", "likes", 0, 0.9), ("1", "likes", 1, 0.2)], "review_id string, text_field string, topic_id int, probability double")
    info = spark.createDataFrame([("likes", 0, 7, "kw")], "text_field string, topic_id int, doc_count bigint, top_keywords string")
    out = reshape.text_classified(reviews, docs, info)
    assert out.columns == [c for c in cfg.LONG_COLUMNS if c in out.columns]
    assert sorted((r.review_id, r.text_field, r.topic_id, r.top_keywords) for r in out.collect()) == [
        ("1", "likes", 0, "kw"), ("1", "use_case", None, None), ("2", "dislikes", None, None),
    ]


def test_heatmap_refuses_too_many_aspects(spark):
    rows = [aspect("p", f"g{n}", "likes", 4.0) for n in range(4)]
    with pytest.raises(ValueError):
        se.heatmap(se.net_scores(spark.createDataFrame(rows, ASPECTS)), max_labels=3)
