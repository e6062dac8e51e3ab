"""What the physical plans must and must not contain, and lookups on either side of the size bound."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import dedup, lookup, reshape
from reviewlens.operators import sentiment as se
from reviewlens.plans import inputs as i
from reviewlens.plans import registry

SF = "/root/testdata/sf0.001"
registry.load()


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize(
    "name", ["win_pivot_heatmap", "agg_net", "jn_topic_info", "agg_topic_dist", "tm_ctfidf", "tm_knn", "tm_reassign_outliers", "set_wide_to_long"]
)
def test_no_cross_join(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedupe_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"))
    text = plan(dedup.keep_first(df, ["k"], "seq"))
    assert "WindowGroupLimit" in text.split("Exchange")[-1]


def test_array_is_built_above_the_join(spark):
    """No test on the exploded array is pushed down to the scan."""
    text = plan(se.split_sentences(i.reviews_long(spark, SF)))
    below = text.split("Exchange")[-1]
    assert "split(" not in below


def test_scan_reads_only_what_is_used(spark):
    text = plan(i.reviews_long(spark, SF).select("review_id", "product_name"))
    assert "text:string" not in text and "html" not in text


def docs_and_info(spark):
    docs = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("topic_id"))
    info = docs.groupBy("topic_id").agg(F.count("*").alias("doc_count")).withColumn("label", F.col("topic_id").cast("string"))
    return docs, info


def test_small_lookup_is_broadcast(spark):
    docs, info = docs_and_info(spark)
    assert "BroadcastHashJoin" in plan(reshape.join_topic_info(docs, info))


def test_large_lookup_is_shuffled_with_the_same_result(spark, monkeypatch):
    docs, info = docs_and_info(spark)
    monkeypatch.setattr(lookup, "KNOWN_BYTES", -1)  # as if Spark could not tell the size
    near = lookup.join_small(docs, info, ["topic_id"])
    assert "BroadcastHashJoin" in plan(near)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = lookup.join_small(docs, info, ["topic_id"], max_rows=10)
        far_plan, far_rows = plan(far), far.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in far_plan or "ShuffledHashJoin" in far_plan
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far_rows))


def test_lookup_of_few_wide_rows_is_shuffled(spark, monkeypatch):
    docs, info = docs_and_info(spark)
    monkeypatch.setattr(lookup, "KNOWN_BYTES", -1)
    monkeypatch.setattr(lookup, "MAX_BYTES", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(lookup.join_small(docs, info.withColumn("wide", F.repeat(F.lit("x"), 400)), ["topic_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_do_not_depend_on_partitioning(spark):
    long_df = i.reviews_long(spark, SF).withColumns({"macro_group": F.lit("g"), "group_label": F.lit("G")})
    chain = lambda df: sorted(map(tuple, se.score_chain(df, se.score_with_lexicon).collect()))
    assert chain(long_df.repartition(1)) == chain(long_df.repartition(13))


def test_hot_review_id(spark):
    """One id on a third of all rows leaves one row, the first."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("review_id"), F.col("id").alias("seq"))
    out = dedup.keep_first(df, ["review_id"], "seq")
    assert out.count() == 6001 and out.filter("review_id = -1").first().seq == 0
