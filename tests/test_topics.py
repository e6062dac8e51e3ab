import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import clustering as cl
from reviewlens.operators import grouping as gr
from reviewlens.operators import topics as tp
from reviewlens.operators import vectors as ve


def blobs(spark, sizes, dim=16, noise=0.05, seed=3, copies=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label, size in enumerate(sizes):
        center = rng.normal(size=dim)
        center /= np.linalg.norm(center)
        for _ in range(size):
            rows.append((n, [float(v) for v in center + noise * rng.normal(size=dim)], label))
            n += 1
    for _ in range(copies):
        rows.append((n, rows[0][1], 0))
        n += 1
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def purity(rows):
    df = pd.DataFrame([(r.label, r.topic_id) for r in rows if r.topic_id != -1], columns=["label", "topic"])
    return df.groupby("topic")["label"].agg(lambda s: s.value_counts().iloc[0]).sum() / len(df)


def test_density_clusters_find_blobs(spark):
    df = blobs(spark, [120, 100, 80, 60])
    out = cl.density_clusters(df, "vec_id", pivots=40).join(df, "vec_id").collect()
    assert len(out) == 360  # every row once
    assert purity(out) == 1.0
    assert sum(r.topic_id != -1 for r in out) >= 0.9 * len(out)
    sizes = pd.Series([r.topic_id for r in out if r.topic_id != -1]).value_counts()
    assert list(sizes.sort_index()) == sorted(sizes, reverse=True) and sizes.min() >= 10


def test_one_vector_holding_a_third_of_the_rows(spark):
    df = blobs(spark, [100, 100], copies=100)
    out = cl.density_clusters(df, "vec_id", pivots=20).join(df, "vec_id").collect()
    assert len(out) == 300 and purity(out) == 1.0
    assert len({r.topic_id for r in out if r.vec_id >= 200 or r.vec_id == 0}) == 1


def test_small_clusters_are_noise(spark):
    df = blobs(spark, [60, 4])
    out = cl.density_clusters(df, "vec_id", pivots=16, min_points=2).join(df, "vec_id").collect()
    assert {r.topic_id for r in out if r.label == 1} == {-1}


def brute_components(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_components_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 40
    edges = [tuple(map(int, rng.integers(0, n, 2))) for _ in range(25)] + ([(k, k + 1) for k in range(20, 39)] if seed == 2 else [])
    nodes = spark.createDataFrame([(k,) for k in range(n)], "cell bigint")
    got = cl.components(nodes, spark.createDataFrame(edges, "cell_a bigint, cell_b bigint")).collect()
    assert [r.component for r in sorted(got, key=lambda r: r.cell)] == brute_components(n, edges)


def test_nearest_in_blocks_equals_one_block(spark):
    df = blobs(spark, [30, 30, 30])
    centroids = ve.mean_vectors(df.withColumn("topic_id", F.col("vec_id") % 30), ["topic_id"])
    run = lambda block: ve.nearest(df, centroids, "topic_id", k=3, block=block).select(
        "vec_id", F.transform("near", lambda s: s["id"]).alias("ids"), F.round("exp_sum", 9).alias("e")
    )
    assert sorted(map(tuple, run(4096).collect())) == sorted(map(tuple, run(8).collect()))


def test_nearest_matches_brute_force(spark):
    df = blobs(spark, [20, 20])
    rows = df.collect()
    x = np.array([r.embedding for r in rows])
    centers = {5: x[:20].mean(0), 9: x[20:].mean(0), 7: -x[0]}
    table = spark.createDataFrame([(k, [float(v) for v in c]) for k, c in centers.items()], "topic_id int, centroid array<double>")
    got = {r.vec_id: r for r in ve.soft_probability(df, table).collect()}
    for r, v in zip(rows, x):
        s = {k: v @ c / np.linalg.norm(v) / np.linalg.norm(c) for k, c in centers.items()}
        best = max(s, key=s.get)
        assert got[r.vec_id].best_topic == best
        assert abs(got[r.vec_id].probability - np.exp(s[best]) / sum(np.exp(list(s.values())))) < 1e-9


def test_reassign_outliers(spark):
    df = blobs(spark, [30, 30]).withColumn("topic_id", F.when(F.col("vec_id") % 5 == 0, -1).otherwise(F.col("label")))
    out = ve.reassign_outliers(df).collect()
    assert len(out) == 60 and all(r.topic_id == r.label for r in out)
    assert all(r.was_outlier == (r.vec_id % 5 == 0) for r in out)


def test_merge_smallest_into_nearest(spark):
    rows = [(0, [1.0, 0.0], 50), (1, [0.0, 1.0], 40), (2, [0.9, 0.1], 3), (3, [0.1, 0.9], 5)]
    table = spark.createDataFrame(rows, "topic_id int, centroid array<double>, n_vectors bigint")
    got = {r.topic_id: r.merged_topic for r in ve.merge_topics(table, 2).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 1}
    with pytest.raises(ValueError):
        ve.merge_topics(table, 2, limit=3)


def test_kmeans_and_reduction(spark):
    df = blobs(spark, [50, 50])
    assert purity(cl.kmeans_topics(df, 2).collect()) == 1.0
    assert {len(r.reduced) for r in ve.reduce_dims(df, 5).collect()} == {5}


def test_plugged_in_encoder(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "de")], "doc_id bigint, text string")
    got = ve.embed_with(df, lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]), "doc_id", batch=1)
    assert {(r.doc_id, tuple(r.embedding)) for r in got.collect()} == {(1, (3.0, 1.0)), (2, (2.0, 1.0))}


def test_ctfidf_by_hand(spark):
    docs = spark.createDataFrame([(0, "bank bank report"), (1, "bank payroll")], "topic_id int, text string")
    got = {(r.topic_id, r.term): r.weight for r in tp.ctfidf(docs, ["topic_id"], stop=["zz"], min_df=1, max_df=1.0).collect()}
    # topic 0: bank 2, report 1, bank bank 1, bank report 1 = 5; topic 1: bank, payroll, bank payroll = 3; mean 4
    assert abs(got[(0, "bank")] - np.sqrt(2 / 5) * np.log(1 + 4 / 3)) < 1e-12
    assert abs(got[(1, "payroll")] - np.sqrt(1 / 3) * np.log(1 + 4 / 1)) < 1e-12


def test_keyword_cleaning(spark):
    ranked = spark.createDataFrame(
        [(0, t, n) for n, t in enumerate(["net suite", "suite net", "oracle db", "bank", "ok", "365", "123", "my cloud", "ledger"], 1)],
        "topic_id int, term string, term_rank int",
    )
    assert tp.clean_keywords(ranked, ["topic_id"]).first().top_keywords == "suite net, bank, ledger"


def test_topic_info(spark):
    docs = spark.createDataFrame([(0,), (0,), (1,), (-1,)], "topic_id int")
    kw = spark.createDataFrame([(0, "oracle, sap erp, xero, bank")], "topic_id int, top_keywords string")
    rows = {r.topic_id: r for r in tp.topic_info(docs, kw).collect()}
    assert (rows[0].doc_count, rows[0].label, rows[0].is_product_cluster) == (2, "oracle | sap erp | xero", True)
    assert (rows[1].top_keywords, rows[1].is_product_cluster) == ("unlabelled", False)
    assert rows[-1].label.startswith("outlier") and not rows[-1].is_product_cluster


GROUPING = {
    "text_field": "likes",
    "macro_groups": [
        {"group_key": "a", "group_label": "A", "group_description": "", "topic_ids": [1, 2, 3], "reasoning": ""},
        {"group_key": "b", "group_label": "B", "group_description": "", "topic_ids": [3, 4], "reasoning": ""},
    ],
    "noise_topic_ids": [4],
    "ungrouped_topic_ids": [5],
}


def test_last_claim_and_noise_win(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps(GROUPING))
    grouping = spark.read.schema(gr.GROUPING_SCHEMA).json(str(tmp_path / "g.json"))
    got = {r.topic_id: r.macro_group for r in gr.grouping_mapping(grouping).collect()}
    assert got == {1: "a", 2: "a", 3: "b", 4: "noise"}
    topics = spark.createDataFrame([("likes", t) for t in (-1, 1, 2, 3, 4, 5)], "text_field string, topic_id int")
    issues = {(r.issue, r.subject) for r in gr.audit(gr.grouping_claims(grouping), topics).collect()}
    assert issues == {
        ("claimed_more_than_once", "3"), ("claimed_more_than_once", "4"), ("not_grouped", "5"), ("undersized_group", "b"),
        ("group_count", "groups"),
    }


def topic_table(spark):
    rows = [("likes", 0, "ap, gl", 5), ("likes", 1, "unlabelled", 3), ("likes", -1, "outlier", 9), ("likes", 2, "bank", 2)]
    return spark.createDataFrame(rows, "text_field string, topic_id int, top_keywords string, doc_count bigint")


def test_enrichment_is_cached(spark, tmp_path):
    path = str(tmp_path / "cache")
    info = topic_table(spark)
    rows = {r.topic_id: r for r in gr.enrich_and_cache(info, path).collect()}
    assert set(rows) == {0, 1, 2}
    assert rows[0].resolved_keywords == "accounts payable, general ledger" and rows[0].plain_description == "Keywords: ap, gl"
    assert rows[1].is_noise and rows[1].noise_reason == "No keywords available"
    assert gr.enrich(info, spark.read.parquet(path)).count() == 0
    changed = info.withColumn("top_keywords", F.when(F.col("topic_id") == 2, "bank, cash").otherwise(F.col("top_keywords")))
    assert [r.topic_id for r in gr.enrich(changed, spark.read.parquet(path)).collect()] == [2]


def test_failing_enricher_falls_back(spark):
    def broken():
        def run(pdf):
            raise RuntimeError("down")

        return run

    def working():
        return lambda pdf: pd.DataFrame(
            {"resolved_keywords": pdf["top_keywords"], "plain_description": ["about " + k for k in pdf["top_keywords"]],
             "candidate_categories": [["x"]] * len(pdf), "is_noise": [False] * len(pdf), "noise_reason": [None] * len(pdf)}
        )

    down = {r.topic_id: r for r in gr.enrich(topic_table(spark), factory=broken).collect()}
    assert down[0].plain_description == "Keywords: ap, gl" and down[0].candidate_categories == ["other"] and not down[0].is_noise
    up = {r.topic_id: r for r in gr.enrich(topic_table(spark), factory=working).collect()}
    assert up[0].plain_description == "about ap, gl" and up[1].plain_description == "Unlabelled topic"


@pytest.mark.parametrize("per_group", [60, 600, 6000])
def test_clusters_do_not_depend_on_the_number_of_rows(spark, per_group):
    df = blobs(spark, [per_group] * 8, dim=32)
    out = cl.density_clusters(df, "vec_id", pivots=64).join(df, "vec_id").collect()
    assert len({r.topic_id for r in out} - {-1}) == 8 and purity(out) >= 0.95
    assert sum(r.topic_id == -1 for r in out) <= 0.05 * len(out)


def test_rows_without_vector_or_topic_stay(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [0.9, 0.1], -1), (4, None, -1), (5, [0.5, 0.5], None), (6, None, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, topic_id int")
    got = {r.vec_id: (r.topic_id, r.was_outlier) for r in ve.reassign_outliers(df).collect()}
    assert got == {1: (0, False), 2: (1, False), 3: (0, True), 4: (-1, True), 5: (None, False), 6: (None, False)}
    alone = {r.vec_id: r.topic_id for r in ve.reassign_outliers(df.filter("topic_id = -1")).collect()}
    assert alone == {3: -1, 4: -1}
    assert {r.topic_id for r in cl.density_clusters(df.select("vec_id", "embedding"), "vec_id", pivots=2).filter("vec_id IN (4, 6)").collect()} == {-1}


def test_neighbours_against_all_pairs_and_in_blocks(spark):
    df = blobs(spark, [40, 40], copies=30)
    x = {r.vec_id: np.array(r.embedding) for r in df.collect()}
    got = cl.neighbours(df, "vec_id", k=3, pivots=1, block=10_000).collect()
    for key in x:
        d = sorted((round(float(np.linalg.norm(x[key] - v)), 9), i) for i, v in x.items() if i != key)[:3]
        assert [(r.neighbour, r.rank) for r in sorted((r for r in got if r.vec_id == key), key=lambda r: r.rank)] == [(i, n) for n, (_, i) in enumerate(d, 1)]
    cut = cl.neighbours(df, "vec_id", k=3, pivots=2, block=16).groupBy("vec_id").count().collect()
    assert len(cut) >= 100 and max(r["count"] for r in cut) == 3


def test_neighbours_are_exact_across_blocks(spark):
    """Recall is 1 however the rows are dealt: the given vectors in 8 blocks, and blobs with many copies in 16."""
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    for df, block in ((given, 64), (blobs(spark, [60, 60, 60], noise=0.5, copies=70).select("vec_id", "embedding"), 16)):
        rows = sorted(df.collect(), key=lambda r: r.vec_id)
        ids, x = [r.vec_id for r in rows], np.stack([np.array(r.embedding) for r in rows]).astype("float64")
        got = {}
        for r in cl.neighbours(df, "vec_id", k=5, pivots=16, block=block).collect():
            got.setdefault(r.vec_id, {})[r.rank] = r.neighbour
        for at, i in enumerate(ids):
            d = np.floor(np.sqrt(((x - x[at]) ** 2).sum(axis=1)) * 1e9 + 0.5) / 1e9
            d[at] = np.inf
            assert got[i] == {n: ids[j] for n, j in enumerate(np.argsort(d, kind="stable")[:5], 1)}
