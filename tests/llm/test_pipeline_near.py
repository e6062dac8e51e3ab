import random

import corpus_pipeline as cp
from test_near_dup import slow as slow_links

SF = "/root/testdata/sf0.001"


def check(spark, df):
    rows = [tuple(r) for r in df.collect()]
    stay = {i for i, _, _, kept in slow_links([(r[0], r[1]) for r in rows], 5) if kept}
    assert sorted(tuple(r) for r in cp.near_dedup(spark, df, SF).collect()) == sorted(r for r in rows if str(r[0]) in stay)
    return len(rows) - len(stay)


def test_near_takes_five_words(spark):
    assert check(spark, spark.read.parquet(f"{SF}/documents.parquet")) > 0


def test_documents_that_share_word_pairs_only_stay(spark, docs):
    """Blocks of twelve words in another order share most pairs, but too few runs of five words; a changed tail is a copy."""
    rng = random.Random(5)
    blocks = [[f"b{k}w{n}" for n in range(12)] for k in range(40)]
    moved = rng.sample(blocks, len(blocks))
    texts = [[w for b in x for w in b] for x in (blocks, moved)]
    texts.append([*texts[0][:-3], "x", "y", "z"])
    assert check(spark, docs([(n, " ".join(t)) for n, t in enumerate(texts)])) == 1
