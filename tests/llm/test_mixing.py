import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import mixing
from reviewlens.llm.common import word_count


def slow_targets(sizes, share=1.5, most=2.0):
    """Sharing again and again, as the rule says it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, [s for s in names], share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 1000, "c": 5, None: 700}, {"a": 0, "b": 0}, {"a": 0, "b": 9}, {"x": 5}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 3}]
)
def test_targets_against_repeated_sharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.target_sizes(df).collect()}
    want = slow_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_edges(docs):
    rows = [(n, "w " * (1 + n % 9), "en", f"s{n % 4}") for n in range(400)] + [(900, None, "en", None), (901, "", "en", "s0"), (None, "a b", "en", None), (5, "w w", "en", "s1"), (5, "w w", "en", "s1")]
    df = docs(rows, target=1, taken="t", size=3)
    got = mixing.mix_sizes(df).collect()
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = slow_targets(size)
    taken = Counter()
    sources = {tuple([r.source_size, round(r.target, 6)]): None for r in got}
    assert len(got) == len(rows) and len(sources) <= len(size)
    for r in got:
        assert r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        taken[round(r.target, 6)] += r.taken
    for s, t in want.items():
        assert t == 0 or abs(taken[round(t, 6)] - t) < 0.3 * t + 5
    again = mixing.mix_sizes(df.repartition(7)).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    # The mix holds every row as often as the sizes say, with the columns of the input.
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.select(word_count(mixed.text).alias("n")).groupBy().sum("n").first()[0] == sum(r.taken for r in got)


def test_empty(docs):
    assert mixing.mix_sizes(docs([])).collect() == [] and mixing.mix(docs([])).collect() == []


def test_hot_source(docs):
    rows = [(n, "a b c", "en", "hot" if n % 10 else f"s{n % 7}") for n in range(2000)]
    got = mixing.mix_sizes(docs(rows)).collect()
    hot = [r for r in got if r.source_size > 3000]
    assert abs(sum(r.taken for r in hot) - hot[0].target) < 0.05 * hot[0].target


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.text("abcd", min_size=1, max_size=2), st.integers(0, 50), min_size=1, max_size=6))
def test_rule_itself(sizes):
    t = slow_targets(sizes)
    assert all(t[s] <= 2 * sizes[s] + 1e-9 for s in sizes)


def test_draw_is_the_hash(docs):
    rows = [(n, "w", "en", "s") for n in range(50)]
    got = {r.doc_id: r.copies for r in mixing.mix_sizes(docs(rows)).collect()}
    for n in range(50):
        u = (int(hashlib.md5(f"mix-1/{n}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        assert got[n] == 1 + (u < 0.5)


def test_names_of_the_input_stay(docs):
    """Columns with names that the operators use inside come out as they went in, in every stage."""
    from reviewlens.llm import compression, extendible, near_dup, quality

    text = lambda n: " ".join(f"w{n}x{k}" for k in range(60 + n % 7))
    names = ["__key", "__rate", "__times", "__one", "row", "one", "rate", "__salt", "__id", "__gone", "__good", "hash", "sha", "copies", "bucket", "score", "__zq_score", "key", "n", "node"]
    df = docs([(n, text(n), "en", f"s{n % 3}") for n in range(60)], **{c: f"mine {c}" for c in names})
    labels = df.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality", "0 AS toxic")
    for out in (mixing.mix(df), compression.keep_good(df, labels), extendible.drop_copies(df), near_dup.drop_near_copies(df), quality.keep_good(df)):
        rows = out.collect()
        assert out.columns == df.columns and all(r[c] == f"mine {c}" for r in rows for c in names)
        assert all(r.text == text(r.doc_id) for r in rows)


def test_very_long_texts(docs):
    rows = [(1, "word " * 400_000, "en", "a"), (2, "w " * 10, "en", "b"), (3, "x" * 2_000_000, "en", "b")]
    assert {r.doc_id: r.size for r in mixing.mix_sizes(docs(rows)).collect()} == {1: 400_000, 2: 10, 3: 1}
    assert {len(r.text) for r in mixing.mix(docs(rows)).collect()} <= {2_000_000, 20}
