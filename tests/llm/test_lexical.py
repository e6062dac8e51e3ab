import math
import re
from collections import Counter

import numpy as np
import pytest

from reviewlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """Scores of every document for every item, as the rule says them."""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_all = len(bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            m = 25 + (75 * len(bag) * n_docs) // n_all
            tf = Counter(bag)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


WORDS = ["the", "The", "of", "a1", "Ünde", "ünde", "x-y", "naïve", "日本語", "İ", "1984", "é"]


def corpus():
    rows = [(n, " ".join(WORDS[(n * k + k * k) % len(WORDS)] for k in range(n % 17))) for n in range(60)]
    rows += [(200 + n, "same words of all") for n in range(25)]  # more ties than places
    return rows + [(7, "a1 a1 a1"), (7, "a1 a1 a1"), (None, "a1 of 1984"), (301, None), (302, ""), (303, " \n.!"), (304, "the " * 30_000 + "1984")]


@pytest.mark.parametrize("sizes", [{}, {"tile": 7, "width": 3}, {"block": 2}, {"block_bytes": 40}])
def test_against_all_scores(spark, docs, sizes):
    rows = corpus()
    items = [(1, "the of a1"), (2, "A1 a1, the; ünde ÜNDE"), (3, "same words"), (4, None), (5, ""), (6, "nowhere"), (None, "1984"), (1, "日本語 é")]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS item")
    got = lexical.search(docs(rows, item_id=1, term="t", n=3, score=2).repartition(5), table, **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs([(1, "a")]), none).count() == 0
    assert lexical.search(docs([(1, "a")]).limit(0), some).count() == 0


def test_tiles_stay_exact_and_whole():
    cells = [(0, 0, 400_000), (1, 0, 3)] + [(0, t, 1 + t * 7919 % 300_000) for t in range(1, 40)] + [(1, t, 2) for t in range(5, 60)]
    weight = np.arange(28_000, 28_060)
    tiles = lexical.weight_tiles(cells, weight, 2, width=16)
    back = Counter()
    for shift, begin, end, r, c, v in tiles:
        assert end - begin <= 16 and all(begin <= x < end for x in c)
        for item in (0, 1):
            assert sum(int(x) for x, i in zip(v, r) if i == item) * lexical.IMPACT_TOP < 1 << 53
        for i, t, x in zip(r, c, v):
            back[int(i), int(t)] += int(x) << shift
    assert back == {(i, t): n * int(weight[t]) for i, t, n in cells}
    assert any(shift for shift, *_ in tiles)


def test_all_equal_scores_are_considered():
    scores, ids = np.array([5, 7, 5, 5, 0, 5]), np.array([9, 8, 3, 1, 0, lexical.MISSING])
    assert ids[lexical.best_of(scores, ids, 3)].tolist() == [8, 1, 3]
    assert ids[lexical.best_of(scores, ids, 9)].tolist() == [8, 1, 3, 9, lexical.MISSING]
