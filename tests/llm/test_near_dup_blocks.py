"""Comparisons across the components of one group, cut into blocks."""

import random

import pytest
from test_near_dup import family, result, slow

from reviewlens.llm import near_dup as nd


def below(rng, n, words, edits):
    """Texts of one base with ``edits`` words replaced in each: mostly just below the threshold."""
    base = [f"w{k}" for k in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(words), edits):
            w[at] = f"e{rng.randint(0, 10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_blocks_against_all_pairs(docs, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(21)
    texts = below(rng, 60, 200, 6) + family(rng, 30, [f"v{k}" for k in range(90)], 8)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert result(docs(rows)) == slow(rows)


def test_two_members_meet_once(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    n = 40
    flat = [0] * nd.PARITY
    # One group: ten members in its largest component, the others alone; equal sketches rule nothing out.
    placed = spark.createDataFrame([(5, k, 0 if k < 10 else k) for k in range(n)], "key long, node long, c long")
    nodes = spark.createDataFrame([(k, 50, flat) for k in range(n)], "doc_id long, n long, parity array<long>")
    got = sorted(map(tuple, nd._across(placed, nodes, 0.8).collect()))
    assert got == sorted((a, b) for a in range(10, n) for b in range(n) if a != b)
