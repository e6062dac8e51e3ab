import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import conform
from reviewlens.streaming import jobs


def land(folder, name, items):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"source_actor": "samstorm", "product_key": "xero", "scraped_at": at, "item_json": json.dumps(item)})
        for at, item in items
    ]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_ingest_keeps_the_first_copy(spark, tmp_path):
    landing, out, ck = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "ck")
    dim = conform.products(spark)
    run = lambda: jobs.run_ingest(spark, str(landing), dim, out, ck)
    first, later = "2024-06-01T00:00:00+00:00", "2024-06-08T00:00:00+00:00"
    land(landing, "a.json", [(first, {"reviewId": "1", "overallRating": 5}), (first, {"reviewId": "2"}), (first, [1])])
    run()
    land(landing, "b.json", [(later, {"reviewId": "1", "overallRating": 1}), (later, {"reviewId": "3"}), (later, {"reviewId": "3"})])
    run()
    run()  # nothing new has landed
    got = sorted((r.review_id, r.scraped_at, r.overall_rating) for r in spark.read.parquet(out).collect())
    assert got == [("1", first, 5.0), ("2", first, None), ("3", later, None)]
    old = "2020-01-01T00:00:00+00:00"
    land(landing, "c.json", [(old, {"reviewId": "new and old"}), (old, {"reviewId": "2", "overallRating": 1})])
    run()
    assert {r.review_id for r in spark.read.parquet(out).collect()} == {"1", "2", "3", "new and old"}
    assert [(r.scraped_at, r.reject_reason) for r in spark.read.parquet(out + "_rejects").collect()] == [(first, "not_object")]


def test_ingest_ranks_and_remembers_in_one_shuffle_without_python(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", [("2024-06-01T00:00:00.123456+00:00", {"reviewId": "1"}), ("2024-06-01T00:00:00.123457+00:00", {"reviewId": "1"})])
    query = jobs.run_ingest(spark, str(landing), conform.products(spark), str(tmp_path / "out"), str(tmp_path / "ck"))
    plan = query._jsq.explainInternal(False)
    assert "StreamingDeduplicate" in plan and "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning(review_id") == 1 and plan.count("parseJson") == 1
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck") == "true"
    assert [r.scraped_ts.microsecond for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [123456]


def test_an_ingest_that_ends_midway(spark, tmp_path, monkeypatch):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    run = lambda: jobs.run_ingest(spark, str(landing), conform.products(spark), out, str(tmp_path / "ck"))
    first, later = "2024-06-01T00:00:00+00:00", "2024-06-08T00:00:00+00:00"
    land(landing, "a.json", [(later, {"reviewId": "1"}), (first, {"reviewId": "2"}), (first, {"reviewId": "1"})])
    write = jobs._append_batches

    def broken(target):
        def both(batch, batch_id):
            write(target)(batch, batch_id)
            if target == out:
                raise RuntimeError("ended")

        return both

    monkeypatch.setattr(jobs, "_append_batches", broken)
    with pytest.raises(Exception, match="ended"):
        run()
    monkeypatch.undo()
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck") == "true"
    land(landing, "b.json", [(first, {"reviewId": "2", "overallRating": 5}), (later, {"reviewId": "3"})])
    run()
    got = sorted((r.review_id, r.scraped_at, r.overall_rating) for r in spark.read.parquet(out).collect())
    assert got == [("1", first, None), ("2", first, None), ("3", later, None)]


def test_compaction_keeps_the_latest_rows(spark, tmp_path):
    out, small = str(tmp_path / "changes"), str(tmp_path / "compacted")
    for n, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)]]):
        spark.createDataFrame(rows, "k string, version int").write.parquet(f"{out}/batch_id={n}")
    before = sorted(map(tuple, jobs.current_rows(spark, out, "k", "version").collect()))
    assert jobs.compact(spark, out, ["k"], [F.col("version").desc(), F.col("batch_id").desc()], small) == 3
    assert sorted(map(tuple, jobs.current_rows(spark, small, "k", "version").collect())) == before == [("a", 2), ("b", 1), ("c", 3)]


def events(spark):
    rows = [(n, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * n), f"p{n % 3}", n / 4) for n in range(200)]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp, product string, value double")


def test_trend_on_a_stream_equals_the_table(spark, tmp_path):
    ev = events(spark)
    for n in range(3):
        ev.filter(F.col("event_id") % 3 == n).write.parquet(str(tmp_path / "landing" / f"drop_{n}"))
    stream = (
        spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "landing"))
    )
    jobs.run_trend(stream, "ts", "product", F.col("value"), str(tmp_path / "out"), str(tmp_path / "ck"), lateness="90 days")
    streamed = jobs.current_trend(spark, str(tmp_path / "out"), "product")
    batch = jobs.trend_rows(jobs.rating_trend(ev, "ts", "product", F.col("value")), "product")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_upserts_keep_the_latest_version(spark, tmp_path):
    schema = "review_id string, version int, rating double"
    landing = str(tmp_path / "landing")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        jobs.run_upserts(stream, "review_id", "version", str(tmp_path / "out"), str(tmp_path / "ck"))

    spark.createDataFrame([("a", 1, 1.0), ("a", 3, 3.0), ("b", 1, 1.0)], schema).write.parquet(landing + "/1")
    run()
    spark.createDataFrame([("a", 2, 2.0), ("b", 2, 2.0), ("c", 1, 1.0)], schema).write.parquet(landing + "/2")
    run()
    got = jobs.current_rows(spark, str(tmp_path / "out"), "review_id", "version").collect()
    assert sorted(map(tuple, got)) == [("a", 3, 3.0), ("b", 2, 2.0), ("c", 1, 1.0)]
