import hashlib
import random
import re
from collections import Counter

import pytest

from reviewlens.llm import spotsigs

WORD = re.compile(r"[0-9a-z'\x80-\U0010ffff]+")


def slow_set(text):
    """Anchors and chains as the module's description says them, over decoded lines."""
    import xxhash

    digest = lambda s: xxhash.xxh32_intdigest(s.encode())
    if not text:
        return set()
    tokens = []
    for n, line in enumerate(re.split("[\n\r]", text)):
        tokens += [("", True)] + [(w, w in spotsigs.COMMON or len(w) <= 2 or len(w.encode()) <= 2) for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line))]
    if all(common for _, common in tokens):
        words = [w for w, _ in tokens if w]
        return {digest(" ".join(words) if words else text)}
    out = set()
    for n, (w, common) in enumerate(tokens):
        chain = [x for x, c in tokens[n + 1 :] if not c][:3]
        if common and chain:
            out.add(digest(f"{w}:{' '.join(chain)}"))
    return out


def slow_jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def brute(rows):
    import xxhash  # noqa: F401

    out, n = [], len(rows)
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % n][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        own, changed, follower = slow_set(text), slow_set(new), slow_set(after)
        hexed = ["".join(f"{x:08x}" for x in sorted(s)) for s in (own, changed)]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), *hexed, slow_jaccard(own, changed), slow_jaccard(own, follower)))
    return Counter(out)


VOCABULARY = ["the", "of", "Und", "naïve", "la", "Haus", "tree", "river", "x1", "it's", "日本", "è", "runs", "blue,", "stone.\n", "#", "der", "apple", "mountain"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_against_brute_force(spark, docs):
    rows = [(n * 3 - 20, t) for n, t in enumerate(texts(120))]
    rows[5:9] = [(-5, ""), (-2, "the of the"), (1, "###\n!!"), (4, "日本   x")]
    rows += [(1000, "Haus " * 40_000 + "the river"), (2**60, "tree"), (2**60 + 1, "tree")]
    df = docs(rows, part=1, tail="t", hash=2, packed="p", fingerprint="f").repartition(6)
    want = brute(rows)
    for parts in (1, 4, 50):
        assert Counter(map(tuple, spotsigs.with_next(df, parts).collect())) == want


def test_one_document_follows_itself(docs):
    rows = [(3, "the blue river runs")]
    assert Counter(map(tuple, spotsigs.with_next(docs(rows)).collect())) == brute(rows)


def test_repeated_and_missing_ids(docs):
    rows = [(None, t) for t in texts(30, 2)] + [(7, t) for t in texts(90, 3)] + [(8, "the same row")] * 40 + [(9, None), (9, "")]
    got = spotsigs.with_next(docs(rows), 6).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, Counter())[r.fingerprint] += 1
    assert prints[8] == {"".join(f"{x:08x}" for x in sorted(slow_set("the same row"))): 40}
    assert prints[7] == Counter("".join(f"{x:08x}" for x in sorted(slow_set(t))) for i, t in rows if i == 7)
    # Equal rows follow each other, so all but the last are like the next one.
    assert sum(r.near_next == 1 for r in got if r.doc_id == 8) >= 39
    assert spotsigs.with_next(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("least", [0.0, 0.3, 0.8, 1.0])
def test_pruned_similarity_is_exact(least):
    from array import array

    rng = random.Random(4)
    for _ in range(400):
        a, b = ({rng.randrange(25) for _ in range(rng.randrange(20))} for _ in range(2))
        exact = slow_jaccard(a, b)
        assert spotsigs.jaccard(array("I", sorted(a)), array("I", sorted(b)), least) == (exact if exact >= least else 0.0)


def test_sizes_that_can_match_are_in_neighbouring_parts():
    for n in range(1, 400):
        for m in range(n, n * 100 // 80 + 1):
            assert spotsigs.length_part(m, 80) - spotsigs.length_part(n, 80) in (0, 1)


def slow_components(rows, percent):
    sets = {i: slow_set(t) for i, t in rows if i is not None}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_against_all_pairs(docs, block):
    rng = random.Random(5)
    words = [f"word{n}" for n in range(400)] + ["the", "of", "and"] * 60
    base = [[rng.choice(words) for _ in range(rng.randrange(40, 160))] for _ in range(12)]
    rows = []
    for n in range(90):
        text = list(base[n % 12])
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((n, " ".join(text)))
    rows += [(200 + n, rows[0][1]) for n in range(30)] + [(None, rows[0][1]), (300, ""), (301, None), (302, "the of")]
    got = spotsigs.near_duplicates(docs(rows, key=1, n="n", rep="r"), block=block).collect()
    want = slow_components(rows, 80)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter([(i, c) for i, c in want.items()] + [(None, None)])
    assert {r.doc_id for r in got if r.kept} == {i for i, c in want.items() if i == c} | {None}
    assert len(set(want.values())) < 60
