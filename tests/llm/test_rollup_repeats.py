from harness import compare, connect

from reviewlens.llm import queries as llm_queries


def test_rows_with_the_same_or_no_id_count_each(spark, docs, tmp_path):
    rows = [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (1, "d e", "de", None), (2, "bad text", "en", "s"), (2, "bad too", "en", "t"), (3, None, None, "s")]
    rows += [(None, f"w {n % 3}", "en", "s") for n in range(7)] + [(None, "", None, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    duck = tmp_path / "duck"
    duck.mkdir()
    for t in ("documents", "labels"):
        spark.read.parquet(str(tmp_path / f"{t}.parquet")).toPandas().astype({"doc_id": "Int64"}).to_parquet(duck / f"{t}.parquet")
    name = "op10_token_rollups"
    got = llm_queries.QUERIES[name](spark, str(tmp_path))
    assert compare(got, connect(str(duck)), llm_queries.ORACLES[name]) is None
    assert sum(r.n_docs for r in got.collect()) == len(rows) - 2
