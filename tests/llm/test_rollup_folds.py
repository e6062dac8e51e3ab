"""Buckets of the token ledger: what a commit reads, folding, and jobs that end midway."""

import os
import shutil

import pytest
from test_rollup import EVENT, slow, totals

from reviewlens.llm import rollup
from reviewlens.session import scratch_path


def batches(n):
    first = [("insert", i, "a" if i % 3 else "b", "en", "t1", i % 11) for i in range(200)]
    return [first] + [[("revise", (7 * k + j) % 200, "a", "de", "t1", k + j) for j in range(5)] + [("delete", 3 * k, None, None, None, None)] for k in range(1, n)]


def rows(ledger):
    return sorted(tuple(r) for r in ledger.current().collect())


def test_same_counts_whatever_is_folded(spark, monkeypatch):
    never = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=4)
    monkeypatch.setattr(never, "fold_due", lambda: [])
    often = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=4, share=0.0, max_batches=2)
    for n, events in enumerate(batches(4)):
        for ledger in (never, often):
            ledger.commit(f"b{n}", spark.createDataFrame(events, EVENT))
    assert not any(r.n for r in never._state()) and all(r.n for r in often._state())
    assert totals(never) == totals(often) == slow(batches(4))
    assert rows(never) == rows(often)
    assert not often.commit("b2", spark.createDataFrame(batches(4)[2], EVENT)) and totals(often) == slow(batches(4))


def test_a_commit_reads_the_buckets_of_its_ids(spark, monkeypatch):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=16)
    ledger.commit("load", spark.createDataFrame(batches(1)[0], EVENT))
    seen = []
    whole = rollup.TokenLedger._signed
    monkeypatch.setattr(rollup.TokenLedger, "_signed", lambda self, state, only=None: seen.append(only) or whole(self, state, only))
    ledger.commit("one", spark.createDataFrame([("revise", 5, "a", "en", "t1", 1000)], EVENT))
    assert len(seen[0]) == 1  # the buckets that the commit itself reads; folds come after


def test_a_fold_that_ended_midway_does_not_count(spark, monkeypatch):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=4)
    data = batches(3)
    ledger.commit("b0", spark.createDataFrame(data[0], EVENT))

    def stop(*_):
        raise RuntimeError("ended")

    with monkeypatch.context() as m:
        m.setattr(rollup.TokenLedger, "_write_state", stop)  # the rows of the fold are there, its commit is not
        with pytest.raises(RuntimeError):
            ledger.commit("b1", spark.createDataFrame(data[1] * 20 + [("insert", 500 + i, "c", "en", "t1", 1) for i in range(200)], EVENT))
    assert os.listdir(f"{ledger.path}/standing")
    after = slow([data[0], data[1] + [("insert", 500 + i, "c", "en", "t1", 1) for i in range(200)]])
    assert totals(ledger) == after
    assert len(rows(ledger)) == sum(n for n, _ in after.values())
    assert ledger.fold_due() and len(rows(ledger)) == sum(n for n, _ in after.values())


def test_a_batch_that_ended_before_its_sums_is_written_again(spark, monkeypatch):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=4)
    data = batches(2)
    ledger.commit("b0", spark.createDataFrame(data[0], EVENT))
    with monkeypatch.context() as m:
        m.setattr(ledger, "fold_due", lambda: [])  # folds come after the sums
        ledger.commit("b1", spark.createDataFrame(data[1], EVENT))
    shutil.rmtree(f"{ledger.path}/sums/00000002-b1")
    assert ledger.batches() == ["b0"] and totals(ledger) == slow(data[:1])
    assert ledger.commit("b1", spark.createDataFrame(data[1], EVENT)) and totals(ledger) == slow(data)


def test_empty_ledger(spark):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"), buckets=4)
    assert ledger.batches() == [] and rows(ledger) == [] and totals(ledger) == {}
    ledger.commit("none", spark.createDataFrame([], EVENT))
    assert ledger.batches() == ["none"] and rows(ledger) == []
