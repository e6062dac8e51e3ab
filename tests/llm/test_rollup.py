from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import rollup
from reviewlens.session import scratch_path

EVENT = "op string, doc_id long, source string, lang string, tokenizer string, tokens long"


def slow(batches):
    state = {}
    for events in batches:
        last = {}
        for op, i, s, la, tk, n in events:
            if op == "delete" and tk is None:
                for key in [k for k in state if k[0] == i]:
                    last.setdefault(key, ("delete", "", "", 0)) if key not in last else None
        for op, i, s, la, tk, n in events:
            if not (op == "delete" and tk is None):
                rank = lambda v: tuple((x is not None, x or "") if k in (1, 2) else x for k, x in enumerate(v))
                new = (op, s, la, n or 0)
                old = last.get((i, tk))
                last[i, tk] = new if old is None or rank(new) > rank(old) else old
        for key, (op, s, la, n) in last.items():
            state.pop(key, None)
            if op != "delete":
                state[key] = (s, la, n)
    docs, tokens = Counter(), Counter()
    for (_, tk), (s, la, n) in state.items():
        docs[s, la, tk] += 1
        tokens[s, la, tk] += n
    return {k: (docs[k], tokens[k]) for k in docs}


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


event = st.tuples(
    st.sampled_from(["insert", "revise", "delete"]), st.sampled_from([1, 2, 3, None]), st.sampled_from(["a", "b", None]), st.sampled_from(["en", None]),
    st.sampled_from(["t1", "t2"]), st.sampled_from([0, 5, 7, None]),
)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(event, max_size=8), min_size=1, max_size=3))
def test_against_recount(spark, batches):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"))
    for n, events in enumerate(batches):
        assert ledger.commit(f"b{n}", spark.createDataFrame(events, EVENT))
        assert not ledger.commit(f"b{n}", spark.createDataFrame(events, EVENT))
    assert totals(ledger) == slow(batches)


def test_whole_document_takedown_and_reinsert(spark):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"))
    batches = [
        [("insert", 1, "a", "en", "t1", 10), ("insert", 1, "a", "en", "t2", 12), ("insert", 2, "a", "en", "t1", 5)],
        [("delete", 1, None, None, None, None)],
        [("revise", 2, "a", "en", "t1", 6), ("insert", 1, "b", "en", "t1", 9)],
    ]
    for n, events in enumerate(batches):
        ledger.commit(str(n), spark.createDataFrame(events, EVENT).repartition(3))
    assert totals(ledger) == slow(batches) == {("a", "en", "t1"): (1, 6), ("b", "en", "t1"): (1, 9)}
    assert ledger.current().count() == 2


def test_interrupted_batch_is_written_again(spark):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"))
    events = spark.createDataFrame([("insert", 1, "a", "en", "t1", 10)], EVENT)
    # The job died after the signed rows and before the sums: nothing counts yet.
    spark.createDataFrame([(9, "x", "x", "x", 99, 1)], "doc_id long, source string, lang string, tokenizer string, tokens long, sign int").write.parquet(f"{ledger.path}/changes/b")
    assert ledger.batches() == [] and totals(ledger) == {}
    assert ledger.commit("b", events)
    assert totals(ledger) == {("a", "en", "t1"): (1, 10)}


def test_empty_batch_bad_names_and_ops(spark):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"))
    none = spark.createDataFrame([], EVENT)
    assert ledger.commit("e", none) and not ledger.commit("e", none) and totals(ledger) == {}
    with pytest.raises(ValueError):
        ledger.commit("a/b", none)
    with pytest.raises(Exception, match="unknown op"):
        ledger.commit("x", spark.createDataFrame([("drop", 1, "a", "en", "t", 1)], EVENT))
    assert ledger.batches() == ["e"]


def test_hot_source_and_extra_columns(spark):
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "ledger"))
    df = spark.range(3000).selectExpr("'insert' AS op", "id AS doc_id", "IF(id % 3 = 0, 'x', 'hot') AS source", "'en' AS lang", "'t' AS tokenizer", "id AS tokens", "1 AS sign", "2 AS n_docs")
    ledger.commit("1", df)
    assert totals(ledger) == {("x", "en", "t"): (1000, sum(range(0, 3000, 3))), ("hot", "en", "t"): (2000, sum(k for k in range(3000) if k % 3))}
