import re
from collections import Counter, defaultdict

import tokenizers

import corpus_pipeline as cp
from reviewlens.llm import compression, mixing
from reviewlens.llm import queries as llm_queries
from harness import compare, connect
from test_mixing import slow_targets
from test_near_dup import slow as slow_links

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out.append((name, docs))
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(stages):
    names = stages[0][1].columns
    assert all(df.columns == names for _, df in stages[1:5])
    assert stages[5][1].columns[: len(names)] == names


def test_quality(stages, spark):
    docs, kept = stages[0][1], stages[1][1]
    scores = compression.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    assert sorted(rows(kept)) == sorted(r for r in rows(docs) if r[0] in want)
    assert len(want) > 0.7 * docs.count()


def test_exact(stages):
    before, after = rows(stages[1][1]), rows(stages[2][1])
    best = {}
    for r in before:
        k = re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
        best[k] = max(best.get(k, r), r)
    assert sorted(after) == sorted(best.values())


def test_near(stages):
    before, after = rows(stages[2][1]), rows(stages[3][1])
    stay = {int(i) for i, _, _, kept in slow_links([(r[0], r[1]) for r in before], 5) if kept}
    assert sorted(after) == sorted(r for r in before if r[0] in stay)


def test_mix(stages):
    before, after = rows(stages[3][1]), rows(stages[4][1])
    times = Counter(after)
    assert set(after) <= set(before)
    size, got = defaultdict(int), defaultdict(int)
    for r in before:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
        size[r[3]] += n
        got[r[3]] += n * times[r]
    want = slow_targets(dict(size))
    for s in size:
        rate = want[s] / size[s] if size[s] else 0
        assert all(times[r] in (int(rate), int(rate) + 1) for r in before if r[3] == s and size[s])
        assert rate != int(rate) or got[s] == rate * size[s]


def test_encode(stages):
    library = tokenizers.Tokenizer.from_file(llm_queries.tokenizer_path())
    before, after = stages[4][1], stages[5][1]
    assert Counter(rows(before)) == Counter(rows(after.select(*before.columns)))
    for r in after.collect():
        assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)


def test_run(stages, spark):
    got = cp.run(spark, SF)
    assert Counter(map(str, got.collect())) == Counter(map(str, stages[-1][1].collect()))


@pytest.mark.parametrize("name", sorted(llm_queries.ORACLES))
def test_twins(spark, name):
    assert compare(llm_queries.QUERIES[name](spark, SF), connect(SF), llm_queries.ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries.QUERIES) == list(range(1, 14))


def test_mix_is_repeatable(stages):
    assert Counter(rows(mixing.mix(stages[3][1].repartition(5)))) == Counter(rows(stages[4][1]))
