"""Scores come back to every row by key: copies, shared keys, nulls; and no aspect is lost from the heatmap."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import sentiment as se
from test_marts import ASPECTS, aspect


def by_length():
    def factory():  # not by reference: workers do not see this module
        def score(pdf):
            n = pdf["pair"].str.len() / 100
            return pd.DataFrame({"positive": n, "neutral": 0.0, "negative": 1 - n})

        return score

    return factory


def rows(spark):
    hot = [("A sentence on a third of all rows.", "price", n) for n in range(400)]
    rest = [(f"Sentence {n} of its own.", ["price", "setup", None][n % 3], 1000 + n) for n in range(700)]
    odd = [("", "price", 2000), (None, "price", 2001), (None, None, 2002), ("ab", "c", 2003), ("a", "bc", 2004), ("x" * 90, "", 2005)]
    return spark.createDataFrame(hot + rest + odd, "sentence string, aspect_term string, n int").withColumn("__n", F.lit("kept"))


def expected(r):
    if r.sentence is None or r.aspect_term is None:
        return None
    return round(len(f"{r.sentence} [SEP] {r.aspect_term}") / 100, 4)


@pytest.mark.parametrize("key", [se.pair_key, lambda s, a: F.coalesce(F.substring(s, 1, 1), F.lit("-"))])
def test_every_row_gets_its_own_score(spark, key):
    df = rows(spark).drop("__n").withColumn("aspect_term", F.coalesce("aspect_term", F.lit("general"))).repartition(6)
    got = se.infer(df, by_length(), key=key).collect()
    assert len(got) == df.count() == len({r.n for r in got})
    for r in got:
        assert (r.positive, r.sentiment_label) == (expected(r), None if r.sentence is None else r.sentiment_label)


def test_a_hot_sentence_stays_where_its_rows_are(spark):
    df = rows(spark).drop("__n").fillna("general", ["aspect_term"]).repartition(8).persist()
    got = se.infer(df, by_length(), heavy_part=10).withColumn("part", F.spark_partition_id())
    hot = got.filter("n < 400").groupBy("part").count().collect()
    assert sum(r["count"] for r in hot) == 400 and len(hot) == 8 and max(r["count"] for r in hot) < 100
    df.unpersist()


def test_keys_tell_pairs_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", "abc"), (None, "abc"), ("abc", None), ("abc", ""), ("1:a", "b"), ("-", "-"), (None, None)], "s string, a string")
    assert df.select(se.pair_key(F.col("s"), F.col("a")).alias("k")).distinct().count() == 9


def test_other_aspects_have_a_column(spark):
    data = [aspect("p", f"g{n}", "likes", float(n + 1)) for n in range(4)] + [aspect("q", "g3", "likes", 2.0)]
    net = se.net_scores(spark.createDataFrame(data, ASPECTS))
    whole = {r.product_name: r.asDict() for r in se.heatmap(net).collect()}
    some = {r.product_name: r.asDict() for r in se.heatmap(net, ["g0", "g1"]).collect()}
    assert set(some) == {"p", "q"} and list(some["p"]) == ["product_name", "g0", "g1", "other aspects"]
    assert [some["p"][g] for g in ("g0", "g1")] == [whole["p"][g] for g in ("g0", "g1")]
    assert some["p"]["other aspects"] == pytest.approx((whole["p"]["g2"] + whole["p"]["g3"]) / 2, abs=0.011) and some["q"]["other aspects"] == whole["q"]["g3"]
    assert "other aspects" not in whole["p"]
    with pytest.raises(ValueError):
        se.heatmap(net, ["g0", "other aspects"])
