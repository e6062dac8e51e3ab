import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import near_dup as nd
from reviewlens.llm.shingles import shingle_sets


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()


def sets_of(text, size=2):
    w = low(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def slow(rows, size=2, percent=80):
    ids = [i for i, _ in rows if i is not None]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    s = [(i, sets_of(t, size)) for i, t in rows if i is not None]
    for (i, a), (j, b) in combinations(s, 2):
        both = len(a & b)
        if both and 100 * both >= percent * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted((str(i), len(sets_of(t, size)), "None" if i is None else str(find(i)), i is None or find(i) == i) for i, t in rows)


def result(df, **options):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in nd.components_of(df, **({"size": 2} | options)).collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n\x0b ", max_size=30), max_size=5), st.integers(1, 4))
def test_sets(texts, size):
    got = shingle_sets([t.encode() for t in texts], size)
    want = [sets_of(t, size) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for (g, w), (h, v) in combinations(zip(got, want), 2):
        assert len(np.intersect1d(g, h)) == len(w & v)


def test_long_words_and_texts_span_blocks():
    rng = random.Random(1)
    t = " ".join("x" * rng.choice([3, 2000, 50]) + str(rng.randint(0, 5000)) for _ in range(6000))
    assert len(t) > 3 << 20
    (got,) = shingle_sets([t.encode()])
    assert len(got) == len(sets_of(t))


def family(rng, n, base, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_planted_groups_against_all_pairs(docs):
    rng = random.Random(11)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 30, 120, 700]))]
        texts += family(rng, 12, base, max(1, len(base) // 14))
    chain = [f"c{k}" for k in range(60)]
    for k in range(8):  # neighbours are alike, the ends are not
        chain = chain[3:] + [f"c{k}new{j}" for j in range(3)]
        texts.append(" ".join(chain))
    texts += ["one", "ONE", "two words", "Two Words", "", None, "  \n", " ".join(f"u{k}" for k in range(900))]
    rng.shuffle(texts)
    rows = [(n * 3 % 1009, t) for n, t in enumerate(texts)] + [(None, "one"), (7000, "z y x w"), (7000, "q r s t"), (7001, "q r s t"), (7002, "z y x w")]
    assert result(docs(rows, component="c", n=0, a=1, b=2).repartition(5)) == slow(rows)


def test_other_shingles_and_threshold(docs):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(100)]
    rows = list(enumerate(family(rng, 20, base, 9)))
    assert result(docs(rows), size=5, threshold=0.5) == slow(rows, 5, 50)


def test_hot_group(docs):
    rng = random.Random(9)
    base = [f"h{k}" for k in range(150)]
    rows = list(enumerate(["same text as ever"] * 400 + family(rng, 250, base, 6) + [f"alone {k} {k * k}" for k in range(100)]))
    assert result(docs(rows)) == slow(rows)


def test_survivors_and_empty(docs):
    kept = nd.drop_near_copies(docs([(3, "a b c d"), (1, "A B C D"), (2, None), (None, "a b c d")], __key=1))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]
    assert nd.components_of(docs([])).collect() == [] and nd.drop_near_copies(docs([])).collect() == []


def test_registers_hold_the_smallest_hash():
    h = np.unique(np.random.default_rng(0).integers(0, 1 << 64, 5000, dtype=np.uint64))
    regs = nd.registers(h)
    for bucket in range(256):
        own = [int(x) & (2**56 - 1) for x in h if int(x) >> 56 == bucket]
        if not own:
            assert regs[bucket] == nd.EMPTY
            continue
        bits = f"{min(own):056b}"
        zeros = bits.index("1")
        assert regs[bucket] == (zeros << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10], 2))


@pytest.mark.parametrize("shared", [0.0, 0.3, 0.67, 0.8, 0.95])
def test_estimate(shared):
    rng = np.random.default_rng(3)
    n, errors = 1500, []
    for _ in range(20):
        both = rng.integers(0, 1 << 64, int(n * shared), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 64, (n - len(both)) // 2, dtype=np.uint64)])) for _ in range(2))
        j, some = nd.estimate(nd.registers(a)[None], nd.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
        errors.append(j[0] - len(both) / (len(a) + len(b) - len(both)))
        assert some[0] <= 256
    assert abs(np.mean(errors)) < 0.03


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(8)
    missed = 0
    for n in (5, 10, 40, 300, 2000):
        for _ in range(60):
            u = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            both = rng.permutation(u)
            a, b = np.sort(both[: max(1, int(np.ceil(0.9 * len(u))))]), np.sort(both[int(0.1 * len(u)) :])
            missed += not np.intersect1d(nd.band_keys(nd.registers(a)), nd.band_keys(nd.registers(b))).size
    assert missed == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5001)]
    got = dict(nd.connected(spark.createDataFrame(links, "a long, b long"), "test").collect())
    assert {got[k] for k in range(201)} == {0} and {got[1000 + k] for k in range(300)} == {1000} and got[5001] == 5000
