import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from reviewlens.llm import extendible as xi


def norm(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def slow(rows):
    best, size = {}, Counter()
    for i, t in rows:
        k = norm(t)
        size[k] += 1
        best[k] = max(best.get(k, i), i, key=lambda v: -1 if v is None else v)
    out, seen = [], set()
    for i, t in sorted(rows, key=str):
        k = norm(t)
        kept = i == best[k] and (i, k) not in seen
        seen.add((i, k))
        out.append((str(i), str(best[k]), size[k], kept, hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out)


def flags(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


ROWS = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "abc "), (9, "x" * 300_000), (10, "X" * 300_000), (3, "abd"), (None, "abc"), (None, "solo")]


def test_edges_against_brute_force(docs):
    assert flags(xi.flag_copies(docs(ROWS, keep_id=0, kept="no", bucket=3))) == slow(ROWS)


def test_empty(docs):
    assert xi.flag_copies(docs([])).collect() == [] and xi.drop_copies(docs([])).collect() == []


def test_hot_text_and_many_buckets(docs, spark):
    rng = random.Random(3)
    rows = [(n, "hot text" if n % 3 == 0 else f"t{rng.randint(0, 900)}") for n in range(3000)]
    assert flags(xi.flag_copies(docs(rows).repartition(7), capacity=16)) == slow(rows)


@pytest.mark.parametrize("hasher", [lambda b: 0, lambda b: (len(b) << 60) % 2**64, lambda b: (len(b) * 0x9E3779B97F4A7C15) % 2**64])
def test_collisions_are_chained_and_compared(docs, hasher):
    rows = [(n, "ab"[n % 2] * (n % 7)) for n in range(60)] + ROWS[:9]
    assert flags(xi.flag_copies(docs(rows).repartition(5), hasher=hasher, capacity=4)) == slow(rows)


def test_survivors_keep_their_columns(docs):
    got = xi.drop_copies(docs([(1, "A", "en", "s1"), (2, "a", "de", None), (3, None)], copies=4))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in got.collect()) == [(2, "a", "de", None), (3, None, "en", "s")]


def test_later_batches_extend_the_index(docs, spark):
    index = xi.ExtendibleIndex(spark, capacity=8)
    rows = []
    for batch in range(3):
        more = [(batch * 100 + n, f"t{(n * 7 + batch) % 60}") for n in range(50)]
        rows += more
        d = docs(more)
        found = index.add(d, xi.fingerprints(d))
    want = {}
    for i, t in rows:
        k, n = want.get(t, (-1, 0))
        want[t] = (max(k, i), n + 1)
    assert {r.text: (r.doc_id, r[xi.COPIES]) for r in found.collect()} == want
    assert index.directory.depth > 1


def test_directory_doubles_only_for_full_depth():
    counts = np.array([9, 0, 0, 0, 1, 1, 1, 1])
    d = xi.grow_directory(counts, 3, 2)
    assert d.depth == 3 and d.slots[4:6] == [d.slots[4]] * 2 and len(d.slots) == 8
    h = np.array([0, 1 << 61, 5 << 61], np.uint64)
    assert list(d.bucket_of(h)) == [d.slots[0], d.slots[1], d.slots[5]]
    assert xi.Directory().bucket_of(h).tolist() == [0, 0, 0]


def test_a_large_directory_is_laid_out_fast():
    import time

    begun = time.time()
    d = xi.grow_directory(np.full(1 << 19, 512), 19, 2_048)
    assert len(d.local) == 1 << 17 and len(d.slots) == 1 << 17 and time.time() - begun < 10
    uneven = np.zeros(1 << 10, int)
    uneven[5], uneven[700:720] = 900, 60
    d = xi.grow_directory(uneven, 10, 100)
    slots = np.array(d.slots)
    assert len(slots) == 1 << d.depth and sorted(set(slots)) == list(range(len(d.local)))
    for b, bits in enumerate(d.local):
        at = np.flatnonzero(slots == b)
        assert len(at) == 1 << (d.depth - bits) and (np.diff(at) == 1).all() and at[0] % len(at) == 0
        keys = uneven[at[0] << (10 - d.depth) : (at[-1] + 1) << (10 - d.depth)].sum()
        assert keys <= 100 or bits == 10
