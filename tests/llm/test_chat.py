import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.llm import chat

EVENT = "conv_id long, seq long, event string, msg long, role string, text string"
TURN = "conv_id long, turn long, role string, text string"


def slow_fold(events):
    """Apply one event after the other."""
    out = {}
    for conv in {e[0] for e in events}:
        state, first = {}, {}
        log = sorted((e for e in events if e[0] == conv), key=lambda e: (e[1] is not None, e[1] or 0, e[2] or "", e[5] or "", e[4] is not None, e[4] or ""))
        roles, gone = {}, set()
        for _, seq, kind, msg, role, text in log:
            state.setdefault(msg, "")
            first.setdefault(msg, seq)
            if role is not None:
                roles.setdefault(msg, role)
            if kind in ("start", "delta"):
                state[msg] += text or ""
            elif kind == "edit":
                state[msg] = text or ""
            elif kind == "regenerate":
                state[msg] = ""
                gone |= {m for m in state if m > msg and first[m] < seq}
            elif kind == "delete":
                gone.add(msg)
        out[conv] = [(m, roles.get(m), state[m]) for m in sorted(state) if m not in gone]
    return out


kinds = st.sampled_from(["start", "delta", "delta", "edit", "regenerate", "delete", "odd", None])
event = st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 30), kinds, st.integers(0, 4), st.sampled_from(["user", "assistant", None]), st.sampled_from(["x", "yz", "", None]))


@settings(max_examples=25, deadline=None)
@given(st.lists(event, min_size=1, max_size=25, unique_by=lambda e: (e[0], e[1])))
def test_fold_against_one_by_one(spark, events):
    got = {r.conv_id: [(m.msg, m.role, m.text) for m in r.messages] for r in chat.fold(spark.createDataFrame(events, EVENT)).collect()}
    assert got == slow_fold(events)


def test_streamed_edited_and_regenerated(spark):
    log = [(1, 0, "start", 0, "user", None), (1, 1, "delta", 0, None, "Hi "), (1, 2, "delta", 0, None, "there"), (1, 3, "start", 1, "assistant", None),
           (1, 4, "delta", 1, None, "bad answer"), (1, 5, "start", 2, "user", "why?"), (1, 6, "regenerate", 1, None, None), (1, 7, "delta", 1, None, "good"),
           (1, 8, "start", 3, "user", "thanks"), (1, 9, "edit", 0, None, "Hello there")]
    (row,) = chat.fold(spark.createDataFrame(log, EVENT).repartition(4)).collect()
    assert [(m.role, m.text) for m in row.messages] == [("user", "Hello there"), ("assistant", "good"), ("user", "thanks")]


def slow_digest(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] is not None, t[3] or ""))
        said = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


text = st.text(alphabet=st.sampled_from(list("a\\</s>[INST]/\n é😀")), max_size=25) | st.sampled_from(["</s>", "[INST]", "[/INST]", "<s>[INST]", "\\</s>", "<\\s>", "[\\/INST]", None, "<<s>s>", "</s"])
turn = st.tuples(st.sampled_from([1, -7, None]), st.sampled_from([0, 1, 2, None]), st.sampled_from(["user", "assistant", "system", "", None, "[/INST]x"]), text)


@settings(max_examples=40, deadline=None)
@given(st.lists(turn, min_size=1, max_size=8))
def test_any_text_is_read_back(spark, turns):
    df = spark.createDataFrame(turns, TURN).withColumn("formatted", F.lit("x")).withColumn("msg", F.lit(1))
    formatted = chat.format_conversations(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(formatted).collect()}
    assert got == slow_digest(turns)
    for r in formatted.collect():
        n = sum(t[0] == r.conv_id for t in turns)
        assert [r.formatted.count(c) for c in ("<s>", "</s>", "[INST]", "[/INST]")] == [n] * 4


@pytest.mark.parametrize("size", [200_000])
def test_long_text(spark, size):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "</s>\\" * (size // 5))]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.format_conversations(spark.createDataFrame(turns, TURN))).collect()}
    assert got == slow_digest(turns)


def test_empty(spark):
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], TURN))).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = chat.digest(chat.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
