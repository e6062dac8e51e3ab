import pytest

from reviewlens.llm import quality as q


def text(n, junk):
    words = [f"w{(n * 31 + k * 17) % 97}x{k}" for k in range(60)]
    return " ".join([w + "#" if k % 2 else w for k, w in enumerate(words)] if junk else words)


@pytest.mark.parametrize("tenths", [3, 4])
def test_limit_stays_where_a_large_part_of_a_source_is_junk(docs, tenths):
    """Symbols at half of the words in 30 or 40 % of the documents; the others have none."""
    rows = [(n, text(n, n % 10 < tenths), "en", "skewed" if n < 200 else "clean") for n in range(300) if n < 200 or n % 10 >= tenths]
    got = {r.doc_id: r for r in q.judge(docs(rows)).collect()}
    assert {n for n, r in got.items() if r.kept} == {n for n, *_ in rows if n % 10 >= tenths}
    assert all(r.max_symbol_rate < 0.5 for r in got.values())


def test_source_without_any_spread(docs):
    """All documents but one are alike; that one is far out, and the language's spread does not save it."""
    rows = [(n, text(1, False), "en", "flat") for n in range(60)] + [(60, text(1, True), "en", "flat")]
    rows += [(100 + n, text(n, False), "en", "other") for n in range(60)]
    assert {r.doc_id for r in q.judge(docs(rows)).collect() if not r.kept} == {60}


SF = "/root/testdata/sf0.1"


def test_given_documents(spark):
    """All documents labelled good are kept but for those that fail the base rules, all labelled bad are dropped; the limits are
    those of the data: rates differ from group to group."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    judged = q.judge(docs).join(labels, "doc_id").filter("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in judged}
    assert n[1, True] >= 0.999 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.99 * (n[0, False] + n.get((0, True), 0))
    found = q.limits(q.document_stats(docs, ["doc_id", "lang", "source"])).collect()
    for m in q.MEASURES:
        assert len({round(r[f"max_{m}"], 6) for r in found}) > 5


def test_rates_without_a_gap_cut_nothing(docs):
    """A language whose texts repeat lines to every degree; its highest rate is as good as the next."""
    rows = [(n, "\n".join([f"a{n}x{k} b{n}y{k} c{n}z{k}" for k in range(40)] + ["once more the very same line"] * (n % 15)), "en", "even") for n in range(400)]
    got = q.judge(docs(rows)).collect()
    assert all(r.kept or r.base_failed for r in got) and sum(r.kept for r in got) > 300
