"""The self-folding table of changes: it reads the same before, during and after folding, and after a job that ended midway."""

import random

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import conform
from reviewlens.streaming import jobs
from reviewlens.streaming.changes import ChangeTable, finished

SCHEMA = "k string, version int, value int"


def batches(n=5, seed=1):
    rng = random.Random(seed)
    return [[(rng.choice([None, *"abcdefghij"]), rng.randrange(6), 100 * b + i) for i in range(rng.randrange(3, 14))] for b in range(n)]


def latest(parts):
    """Highest version, then the later batch; within a batch any row of that version may win."""
    best = {}
    for b, rows in enumerate(parts):
        for k, v, _ in rows:
            best[k] = max(best.get(k, (-1, -1)), (v, b))
    return {(k, v, b) for k, (v, b) in best.items()}


def read(table):
    rows = table.current().collect()
    assert len({r.k for r in rows}) == len(rows)
    return {(r.k, r.version, r.batch_id) for r in rows}


def test_reads_equal_before_during_and_after_folding(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], ["version"], buckets=3, share=0.5, max_batches=2)
    parts, due = batches(), []
    for n, rows in enumerate(parts):
        table.append(spark.createDataFrame(rows, SCHEMA), n)
        assert read(table) == latest(parts[: n + 1])
        state = table.state()
        unfolded = table._changes(state)
        due.append(sum(r.upto == n for r in state))
        for r in [] if unfolded is None else unfolded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("batch_id").alias("b")).collect():
            assert r["n"] <= 0.5 * state[r.bucket].n and r.b <= 2
    assert due[0] == 3 and sum(due) > 3
    assert table.vacuum() > 0 and read(table) == latest(parts)
    assert len(finished(spark, str(tmp_path / "t" / "_folds"))) == 1


def test_a_job_that_ends_midway(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    make = lambda **options: ChangeTable(spark, path, ["k"], ["version"], buckets=3, **options)
    parts = batches(3, seed=2)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in parts]
    make(share=0.5).append(frames[0], 0)
    # It ends after the changes have been written.
    monkeypatch.setattr(ChangeTable, "fold_due", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        make(share=0.0).append(frames[1], 1)
    monkeypatch.undo()
    assert read(make()) == latest(parts[:2])
    # It ends after the fold has been written and before it is committed.
    monkeypatch.setattr(ChangeTable, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        make(share=0.0).append(frames[1], 1)
    monkeypatch.undo()
    assert finished(spark, f"{path}/_base") == ["fold=0", "fold=1"] and read(make()) == latest(parts[:2])
    # The batch comes again, twice, and then the next one.
    for n in (1, 1, 2):
        make(share=0.0).append(frames[n], n)
        assert read(make()) == latest(parts[: n + 1])
    assert [r.upto for r in make().state()] == [2, 2, 2]


def test_folding_reads_its_own_buckets_only(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], ["version"], buckets=4, share=0.5)
    table.append(spark.createDataFrame([(c, 1, 0) for c in "abcdefghijklmnop"], SCHEMA), 0)
    table.append(spark.createDataFrame([("a", 2, 1)], SCHEMA), 1)
    plan = table._changes(table.state())._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "batch_id=0" not in plan
    folded = [r for r in table.state() if r.upto == 1]
    assert len(folded) <= 1 and ("a", 2, 1) in read(table)


def test_batches_without_rows(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], ["version"], buckets=2, share=0.5)
    none = spark.createDataFrame([], SCHEMA)
    table.append(none, 0)
    with pytest.raises(ValueError):
        table.current()
    table.append(spark.createDataFrame([("a", 1, 1)], SCHEMA), 1)
    table.append(none, 2)
    assert read(table) == {("a", 1, 1)}


def test_streams_fold_as_they_go(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    parts = batches(3, seed=4)
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{landing}/{n}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(landing)
        jobs.run_upserts(stream, "k", "version", out, str(tmp_path / "ck"), table={"buckets": 2, "share": 0.0})
    got = {(r.k, r.version) for r in jobs.current_rows(spark, out, "k", "version").collect()}
    assert got == {(k, v) for k, v, _ in latest(parts)}
    assert ChangeTable(spark, out, ["k"], ["version"])._changes(ChangeTable(spark, out, ["k"]).state()) is None


def test_ingest_takes_the_earliest_copy_of_a_batch(spark, tmp_path):
    """Also of an id on most rows of the batch, however the rows are dealt over files."""
    from test_stream import land

    landing, out = tmp_path / "landing", str(tmp_path / "out")
    times = [f"2024-06-{d:02d}T00:00:00+00:00" for d in range(2, 20)]
    for n in range(3):
        land(landing, f"{n}.json", [(t, {"reviewId": "hot", "overallRating": 1}) for t in times[n::3]] + [(times[n], {"reviewId": f"own {n}"})])
    land(landing, "early.json", [("", {"reviewId": "hot"}), ("2024-06-01T00:00:00+00:00", {"reviewId": "hot", "overallRating": 4})])
    run = lambda: jobs.run_ingest(spark, str(landing), conform.products(spark), out, str(tmp_path / "ck"))
    run()
    land(landing, "later.json", [("2020-01-01T00:00:00+00:00", {"reviewId": "hot", "overallRating": 5}), (times[0], {"reviewId": "new"})])
    run()
    rows = {r.review_id: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"hot", "own 0", "own 1", "own 2", "new"} and spark.read.parquet(out).count() == 5
    assert rows["hot"].overall_rating == 4.0 and rows["hot"].scraped_ts.day == 1
