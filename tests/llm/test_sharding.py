import hashlib
import math
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import hash_tree as ht


def slow_draw(key, children):
    def t(name, w):
        bits = int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[:12], 16)
        return (-math.log((bits + 0.5) / 2**48) / w, name)

    return min(t(n, w) for n, w in children.items())[1]


def slow_place(key, tree):
    regions, racks, shards = {}, {}, {}
    for s in tree:
        regions[s.region] = regions.get(s.region, 0) + s.weight
        racks.setdefault(s.region, {}).setdefault(s.rack, 0)
        racks[s.region][s.rack] += s.weight
        shards.setdefault(s.rack, {})[str(s.shard)] = s.weight
    region = slow_draw(key, regions)
    return int(slow_draw(key, shards[slow_draw(key, racks[region])]))


def test_against_brute_force(spark, docs):
    rows = [(n, f"text {n}") for n in range(300)] + [(5, "again"), (5, "again"), (None, None), (7, ""), (8, "é" * 10)]
    got = ht.shard_documents(docs(rows, shard=1, slot="x", region="r")).collect()
    assert len(got) == len(rows)
    tree = ht.topology(24)
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == slow_place(key, tree) and r.grown_shard == slow_place(key, ht.grow(tree)) and r.law == "key"
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_slots_over_many_blocks(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 3 AS INT) AS shard")
    out = ht.number_slots(df, "shard", [df.doc_id], df.doc_id, shards=3, rows_per_block=100).collect()
    for k in range(3):
        own = sorted(r.slot for r in out if r.shard == k)
        assert own == list(range(len(own)))


def test_empty(docs):
    assert ht.shard_documents(docs([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 40))
def test_a_new_shard_only_takes(key, shards):
    before, after = slow_place(str(key), ht.topology(shards)), slow_place(str(key), ht.topology(shards + 1))
    # Beyond the base layout each shard opens its own region; inside it, racks and regions fill up.
    if shards >= 24:
        assert after in (before, shards)


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    tree = ht.topology(24)
    heavier = ht.reweight(tree, 5, 3.0)  # region0, rack1
    rack = {s.shard: s.rack for s in tree}
    region = {s.shard: s.region for s in tree}
    moved = [(a, b) for k in range(3000) if (a := slow_place(str(k), tree)) != (b := slow_place(str(k), heavier))]
    assert moved and all(region[b] == "region0" for _, b in moved)
    assert all(rack[b] == "rack1" for a, b in moved if region[a] == "region0")


def test_weights_set_the_shares(spark):
    tree = [ht.Shard("a", "a1", 0, 3.0), ht.Shard("a", "a1", 1, 1.0), ht.Shard("b", "b1", 2, 4.0), ht.Shard("b", "b1", 3, 0.0)]
    df = spark.range(8000).selectExpr("CAST(id AS STRING) AS k")
    n = {r.shard: r["count"] for r in ht.place(df, df.k, tree).groupBy("shard").count().collect()}
    assert set(n) == {0, 1, 2}
    assert abs(n[0] - 3000) < 200 and abs(n[1] - 1000) < 150 and abs(n[2] - 4000) < 250
